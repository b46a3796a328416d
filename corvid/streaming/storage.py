"""Files on the storage that the cluster shares, by way of Spark's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system of ``path``; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder, in order; nothing if there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def swing(self, name: str, text: str) -> None:
        """Give ``name`` new content in one step: readers see the old text or the new one. Atomic where
        the file system's rename is (HDFS, local and mounted storage; not plain object stores)."""
        fresh = f"{name}.{uuid.uuid4().hex}"
        self.write(fresh, text)
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.conf)
        qualified = [self.fs.makeQualified(self._at(n)) for n in (fresh, name)]
        context.rename(*qualified, options)

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def set_time(self, name: str, millis: int) -> None:
        self.fs.setTimes(self._at(name), millis, -1)
