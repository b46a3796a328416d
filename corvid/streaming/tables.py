"""Tables that a stream's batches change, switched by one pointer (STR-07, STR-21, STR-28).

A table is a folder of data folders, of manifests that name those which make up a version, and of
the file ``_current``, which names the manifest in force. A batch writes its data and its
manifest beside the old ones and then swings ``_current`` in one step. A batch that is killed before
leaves the old version readable; run again, it writes over its own folders; one that had swung
the pointer is skipped when it comes again. Data that the version in force and the one before don't use
are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corvid.streaming.storage import Files

_BUCKET, _VERSION = "__bucket", "__version"


class _Table:
    def __init__(self, spark: SparkSession, path: str):
        self.path, self.files = path.rstrip("/"), Files(spark, path)

    def manifest(self) -> dict | None:
        """The version in force, if there is one."""
        if not self.files.exists("_current"):
            return None
        return json.loads(self.files.read(self.files.read("_current")))

    def _switch(self, manifest: dict, used: set[str], last: dict | None) -> None:
        """Put ``manifest``, whose data folders are ``used``, in force."""
        name = f"manifests/{manifest['version']:012d}.json"
        manifest["used"] = sorted(used)
        self.files.write(name, json.dumps(manifest))
        self.files.swing("_current", name)
        keep = used | set(last["used"] if last else ())
        for folder in self.files.names("data"):
            if f"data/{folder}" not in keep:
                self.files.remove(f"data/{folder}")
        for other in self.files.names("manifests")[:-2]:
            self.files.remove(f"manifests/{other}")

    def _done(self, last: dict | None, version: int) -> bool:
        return last is not None and last["version"] >= version


class SnapshotTable(_Table):
    """A table that every batch replaces whole (complete mode)."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        super().__init__(spark, path)
        self.fmt = fmt

    def write(self, batch: DataFrame, version: int) -> None:
        last = self.manifest()
        if self._done(last, version):
            return
        folder = f"data/v{version:012d}"
        batch.write.mode("overwrite").format(self.fmt).save(f"{self.path}/{folder}")
        self._switch({"version": version, "schema": batch.schema.jsonValue()}, {folder}, last)

    def read(self, spark: SparkSession) -> DataFrame:
        now = self.manifest()
        if now is None:
            raise ValueError(f"no batch has written {self.path}")
        reader = spark.read.schema(StructType.fromJson(now["schema"])).format(self.fmt)
        return reader.load([f"{self.path}/{folder}" for folder in now["used"]])


class UpsertTable(_Table):
    """A table with one row per key, to which every batch brings new rows and changed ones (update
    mode; a key at most once in a batch).

    Rows lie in ``buckets`` by a hash of their key. A batch adds a delta to each bucket that its keys
    fall in and touches no other one. A bucket with more than ``max_deltas`` deltas is compacted: its
    snapshot and deltas become a new snapshot. So a batch costs its own rows, and now and then
    the buckets it has filled up, however large the table. A bucket is written by one task: take
    so many ``buckets`` that one's rows fit a task.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, max_deltas: int = 4):
        super().__init__(spark, path)
        self.keys, self.buckets, self.max_deltas = keys, buckets, max_deltas

    def write(self, batch: DataFrame, version: int) -> None:
        last = self.manifest()
        if self._done(last, version):
            return
        if last and (last["buckets"], last["keys"]) != (self.buckets, self.keys):
            raise ValueError(f"the table has {last['buckets']} buckets by {last['keys']}")
        held = {int(b): list(parts) for b, parts in last["parts"].items()} if last else {}
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = batch.withColumn(_VERSION, F.lit(version).cast("long")).withColumn(_BUCKET, bucket)
        for b, part in self._save(rows, f"data/d{version:012d}").items():
            held.setdefault(b, []).append(part)
        full = [b for b, parts in held.items() if len(parts) > self.max_deltas + 1]
        if full:
            schema = rows.drop(_BUCKET).schema
            for_buckets = self._newest(self._load(batch.sparkSession, schema, [p for b in full for p in held[b]]), batch.columns)
            compact = for_buckets.withColumn(_BUCKET, bucket)
            held.update({b: [part] for b, part in self._save(compact, f"data/s{version:012d}").items()})
        manifest = {"version": version, "schema": batch.schema.jsonValue(), "buckets": self.buckets, "keys": self.keys,
                    "parts": held}
        self._switch(manifest, {p.rsplit("/", 1)[0] for parts in held.values() for p in parts}, last)

    def _save(self, rows: DataFrame, folder: str) -> dict[int, str]:
        """Folders of the buckets that ``rows`` fall in."""
        (rows.repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET)
         .parquet(f"{self.path}/{folder}"))
        found = [n for n in self.files.names(folder) if n.startswith(f"{_BUCKET}=")]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in found}

    def _load(self, spark: SparkSession, schema: StructType, parts: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in parts])

    def _newest(self, rows: DataFrame, columns: list[str], version: bool = True) -> DataFrame:
        """Per key the row of the newest version: an aggregate, so no key is gathered whole."""
        rest = [c for c in columns if c not in self.keys]
        newest = F.max_by(F.struct(F.lit(0).alias("_"), *[F.col(c) for c in rest]), _VERSION).alias("_row")
        out = rows.groupBy(*self.keys).agg(newest, F.max(_VERSION).alias(_VERSION))
        return out.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in columns],
                          *([_VERSION] if version else []))

    def read(self, spark: SparkSession) -> DataFrame:
        now = self.manifest()
        if now is None:
            raise ValueError(f"no batch has written {self.path}")
        schema = StructType.fromJson(now["schema"])
        parts = [p for parts in now["parts"].values() for p in parts]
        if not parts:
            return spark.createDataFrame([], schema)
        return self._newest(self._load(spark, StructType(list(schema.fields)).add(_VERSION, "long"), parts),
                            schema.names, version=False)
