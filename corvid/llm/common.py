"""Shared helpers of the training-data operators: scratch tables, free column names, batch
mapping and grouping of sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.session import scratch_path

#: Fixed value: the white space that separates words, [\x20\x09-\x0D].
SPACE = "\t\n\x0b\x0c\r "
#: The same class, and a word, as a Java regular expression.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts the lineage, and a
    lost executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete the files of materialised tables, once all that read them is itself stored."""
    for df in stored:
        remove(df.sparkSession, df.scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later plan reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def kth_largest(values: DataFrame, col: str, k: int, bins: int = 4096) -> int | None:
    """Exact k-th largest value of a long column: histograms of about ``bins`` bins over an interval
    that shrinks to a single value. None if there are fewer than k rows. Bins are the values without
    their last binary digits, so any range of longs will do."""
    low, high, n = values.agg(F.min(col), F.max(col), F.count(col)).first()
    if k < 1 or n < k:
        return None
    left = k
    while low < high:
        digits = max(0, (high - low).bit_length() - (bins.bit_length() - 1))
        hist = dict(values.where(F.col(col).between(low, high))
                    .groupBy(F.shiftright(F.col(col), digits).alias("bin")).count().collect())
        for b in sorted(hist, reverse=True):
            if hist[b] >= left:
                break
            left -= hist[b]
        low, high = max(low, b << digits), min(high, ((b + 1) << digits) - 1)
    return low


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list], fields: list[T.StructField],
                done: Callable[[], None] | None = None) -> DataFrame:
    """Append the columns that ``fn(batch)`` returns (arrays, one per field) to every row. ``done``
    is called at the end of a task, whose worker may live on for others."""
    schema = T.StructType(list(df.schema.fields) + list(fields))
    names = [f.name for f in schema.fields]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(list(batch.columns) + list(fn(batch)), names=names)
        if done:
            done()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(mapped, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a string column; null becomes the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def text_portions(column: pa.Array, size: int = 1 << 19) -> Iterator[list[str]]:
    """Python strings (null: empty) of consecutive rows of about ``size`` bytes together, so that
    working memory grows with the longest text, not with the batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // size)) + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(column)]):
        if start < stop:
            yield texts_of(column.slice(start, stop - start))


def portions(texts: list[str], chars: int = 1 << 21) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together, to bound working memory."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut rows that arrive sorted by ``keys`` into one table per key. Only the rows of the
    open group are held, so the caller bounds the size of a group before."""
    held: list[pa.RecordBatch] = []
    open_key = None

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*columns))
        start = 0
        for i in range(1, len(rows) + 1):
            if i < len(rows) and rows[i] == rows[start]:
                continue
            if held and rows[start] != open_key:
                yield pa.Table.from_batches(held)
                held = []
            open_key = rows[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield pa.Table.from_batches(held)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None],
               schema: T.StructType) -> DataFrame:
    """``fn`` over every group of ``keys``; groups must be of bounded size."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pa.Table] = []
        rows = 0
        for group in sorted_groups(batches, keys):
            done = fn(group)
            if done is None or not done.num_rows:
                continue
            out.append(done)
            rows += done.num_rows
            if rows >= 20_000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, rows = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    cols = [F.col(k) for k in keys]
    return df.repartition(*cols).sortWithinPartitions(*cols).mapInArrow(mapped, schema)
