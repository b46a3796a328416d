"""Line deduplication against levelled sorted runs of line hashes.

Documents are taken in batches of ascending doc_id. The hashes already seen lie in runs:
tables sorted by hash and bucketed, so that a batch merge-joins every run without shuffling
it. A batch drops the lines whose hash a run holds, and all but the smallest document's of
those that it repeats itself; then its new hashes become a run of level 0. When a level holds
``fanout`` runs, they are compacted into one run of the next level, so a hash is rewritten
once per level and a batch meets few runs.

A line is compared by its key: white space [\\x20\\x09-\\x0D] stripped at both ends, A-Z in
lower case. Keys shorter than ``min_chars`` code points are never dropped.

Defined results: null and empty texts are one empty line. Rows with the same doc_id count as
one document, so neither loses lines to the other. Null ids count as one document behind all
others. Null bytes and any other characters are ordinary. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import SPACE, discard, fresh, materialise, remove
from corvid.session import scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1
_HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(SPACE)), _UPPER, _LOWER)


def key_hash(key: Column) -> list[Column]:
    """128 bits as two longs."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


class HashRuns:
    """Levelled sorted runs of (hash, first document) below the shared scratch folder."""

    def __init__(self, spark, buckets: int, fanout: int = 3):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def all(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, rows: DataFrame, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            merged = self.spark.table(names[0])
            for name in names[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.add(merged, level + 1)
            for name in names:
                self._drop(name)

    def drop(self) -> None:
        for level in self.levels:
            for name in level:
                self._drop(name)
        self.levels = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.paths[name] = scratch_path(self.spark, name)
        (rows.repartition(self.buckets, *_HASH).write.format("parquet")
         .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option("path", self.paths[name]).saveAsTable(name))
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))


def _batch_edges(ids: DataFrame, batches: int) -> list[int]:
    """Smallest id of every batch but the first: approximate quantiles."""
    got = ids.agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(got or []))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                  batches: int = 4, fanout: int = 3) -> DataFrame:
    """``id`` (null ids: the largest long), ``text_hash``, ``pos`` of every line to drop."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
    rows = rows.select("id", "text_hash", "pos", key_of(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    edges = _batch_edges(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id")), batches)
    batch = sum((F.when(F.col("id") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    lines = materialise(rows.select("id", "text_hash", "pos", *key_hash(F.col("key")), batch.alias("batch")), "lines", "batch")

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = HashRuns(spark, buckets, fanout)
    losers, spent = [], []
    for b in range(len(edges) + 1):
        part = lines.where(F.col("batch") == b)
        keys = part.groupBy(*_HASH).agg(F.min("id").alias("first"), F.max("id").alias("last"))
        seen = runs.all()
        if seen:
            found = None
            for i, run in enumerate(seen):
                held = run.select(*_HASH, F.col("first").alias(f"held{i}"))
                keys = keys.join(held.hint("merge"), _HASH, "left")
                found = F.col(f"held{i}") if found is None else F.coalesce(found, F.col(f"held{i}"))
            keys = keys.select(*_HASH, "first", "last", found.alias("held"))
        else:
            keys = keys.withColumn("held", F.lit(None).cast("long"))
        keys = materialise(keys, "keys")
        if b < len(edges):
            runs.add(keys.where("held IS NULL").select(*_HASH, "first"))
        # keys with a line to drop, and the document that keeps it
        repeated = materialise(keys.where("held IS NOT NULL OR first < last")
                               .select(*_HASH, F.coalesce("held", "first").alias("keeper")), "repeated")
        spent += [keys, repeated]
        losers.append(part.join(repeated, _HASH).where("id <> keeper").select("id", "text_hash", "pos"))
    out = losers[0]
    for more in losers[1:]:
        out = out.unionByName(more)
    out = materialise(out, "dropped")
    runs.drop()
    discard(lines, *spent)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 3) -> DataFrame:
    """All rows of ``docs``; ``text_col`` without the dropped lines, and ``n_lines`` (before),
    ``n_dropped``. Lines that stay are joined by line feeds; null texts become empty."""
    n_lines, n_dropped, gone, key, at = (fresh(docs, c) for c in ("n_lines", "n_dropped", "gone_", "key_", "at_"))
    drops = dropped_lines(docs, id_col, text_col, min_chars, batches, fanout)
    per_doc = materialise(drops.groupBy(F.col("id").alias(key), F.col("text_hash").alias(at))
                          .agg(F.collect_set("pos").alias(gone)), "gone")
    discard(drops)
    lines = lines_of(F.col(text_col))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone)),
                       lambda i: F.get(lines, i))
    out = docs.withColumns({key: F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)),
                            at: F.xxhash64(F.col(text_col))}).join(per_doc, [key, at], "left")
    out = out.withColumns({n_lines: F.size(lines).cast("long")})
    out = out.withColumn(n_dropped, F.when(F.col(gone).isNull(), F.lit(0)).otherwise(
        F.size(F.col(gone))).cast("long"))
    out = out.withColumn(text_col, F.when(F.col(gone).isNull(), F.coalesce(F.col(text_col), F.lit("")))
                         .otherwise(F.array_join(kept, "\n")))
    return out.select(*docs.columns, n_lines, n_dropped)

