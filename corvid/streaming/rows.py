"""A sink of single rows (STR-28, ``foreach``): open, process and close per partition and epoch.

Rows of a (partition, epoch) go to a file of their own under ``_attempts``; closing it without an
error moves it to its place, which is the commit. An epoch that comes again, after a failure
between the commit and the query's own record of it, finds the place taken and is skipped. An
attempt that fails is deleted; one whose worker is killed stays unread. So the files that
``read_rows`` sees hold every row once, as long as the source deals an epoch into the same
partitions when it is run again (file sources and Kafka do, without a shuffle after them).
"""

from __future__ import annotations

import json
import re
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

#: Rows held before they are written.
HELD = 5_000


class RowFiles:
    """``foreach`` writer of JSON lines below ``path``. Any file system that pyarrow knows (local and
    mounted storage, HDFS, object stores)."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.names = re.sub(r"^file:/(?!/)", "file:///", path.rstrip("/")), schema.names

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.files, base = fs.FileSystem.from_uri(self.path)
        self.place = f"{base}/rows/{epoch_id:012d}-{partition_id:06d}.json"
        self.attempt, self.stream, self.held = f"{base}/_attempts/{uuid.uuid4().hex}", None, []
        return self.files.get_file_info(self.place).type == fs.FileType.NotFound

    def process(self, row: Row) -> None:
        self.held.append(json.dumps({n: row[n] for n in self.names}, default=str, ensure_ascii=False))
        if len(self.held) >= HELD:
            self._flush()

    def _flush(self) -> None:
        if not self.held:
            return
        if self.stream is None:
            self.files.create_dir(self.attempt.rsplit("/", 1)[0], recursive=True)
            self.files.create_dir(self.place.rsplit("/", 1)[0], recursive=True)
            self.stream = self.files.open_output_stream(self.attempt)
        self.stream.write(pa.py_buffer(("\n".join(self.held) + "\n").encode("utf-8")))
        self.held = []

    def close(self, error: Exception | None) -> None:
        if error is None:
            self._flush()
        if self.stream is None:
            return
        self.stream.close()
        if error is None:
            self.files.move(self.attempt, self.place)
        else:
            self.files.delete_file(self.attempt)


def read_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The committed rows of ``RowFiles``."""
    return spark.read.schema(schema).json(f"{path.rstrip('/')}/rows")
