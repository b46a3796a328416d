"""Sampling, partitioning and persistence (PAR)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.operators.windows import dense_index, running
from corvid.session import materialise


def at_least(df: DataFrame, n: int) -> DataFrame:
    """Spread ``df`` over ``n`` partitions or the cluster's cores, whichever is more. Declared
    in the plan: asking a frame for its partition count would run its shuffles first."""
    return df.repartition(max(n, cluster_parallelism(df)))


def cluster_parallelism(df: DataFrame) -> int:
    """Cores of the cluster (``defaultParallelism``): the scale-aware partition count used
    where an example in the survey names a small fixed number."""
    return df.sparkSession.sparkContext.defaultParallelism


def spread_small_input(df: DataFrame, n: int | None = None) -> DataFrame:
    """Spread rows over the cluster's cores before CPU-heavy per-row work (tokenising,
    regular expressions) when the plan's size estimate makes fewer splits than there are
    cores — a small table would otherwise be processed by one task until the first shuffle.
    Larger inputs are returned unchanged (no shuffle)."""
    n = n or cluster_parallelism(df)
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(n) if size < n * split else df


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the md5 of the key text (same in every run and engine)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(df: DataFrame, key: str, weights: list[float]) -> list[DataFrame]:
    """Deterministic split by key hash into parts proportional to ``weights``."""
    total = sum(weights)
    bounds, acc = [], 0.0
    for w in weights:
        lo = round(acc / total * STEPS)
        acc += w
        bounds.append((lo, round(acc / total * STEPS)))
    b = hash_bucket(key, STEPS)
    return [df.where((b >= lo) & (b < hi)) for lo, hi in bounds]


#: Values of the 32-bit hash that samples compare.
STEPS = 1 << 32


def row_hash(id_cols: list[str], buckets: int = STEPS) -> Column:
    """Stable pseudo-random bucket of a row from its identifying columns (md5 based)."""
    return hash_bucket(F.concat_ws("-", *[F.col(c).cast("string") for c in id_cols]), buckets)


def hash_sample_by_key(df: DataFrame, key: str, fractions: dict, id_cols: list[str]) -> DataFrame:
    """Deterministic stratified sample: a row of stratum ``k`` is kept when its row hash, one of
    ``STEPS``, falls below that share of them; repeatable across runs, engines and executor losses.
    A fraction is at least ``2 ** -20`` (the hash then errs by less than one row in 4,096 of those
    kept), or 0."""
    for k, v in fractions.items():
        if not (v == 0 or 2.0 ** -20 <= v <= 1):
            raise ValueError(f"fraction of {k!r} is {v}: take 0, or 2**-20 to 1")
    frac = F.coalesce(F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])[F.col(key)],
                      F.lit(0.0))
    return df.where(row_hash(id_cols) < frac * STEPS)


def hash_sample_n(df: DataFrame, n: int, id_cols: list[str]) -> DataFrame:
    """Deterministic sample of ``n`` rows without replacement: the ``n`` smallest row hashes
    (ties by the id columns), as a top-k (per-task heaps, no global sort)."""
    return df.withColumn("_h", row_hash(id_cols, 1 << 30)).orderBy("_h", *id_cols).limit(n).drop("_h")


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def sample_n_with_replacement(df: DataFrame, n: int, total: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` draws with replacement (``takeSample(True, n)``), whatever ``n`` is; none
    from an empty frame.

    The draws are uniform row positions, counted per position and joined to the frame's dense
    index, so a row comes back as often as it was drawn.
    """
    if not total:
        return df.limit(0)
    draws = df.sparkSession.range(n).select(F.floor(F.rand(seed) * F.lit(total)).cast("long").alias("_at"))
    draws = materialise(draws.groupBy("_at").agg(F.count("*").cast("int").alias("_times")), "draws")
    placed = dense_index(df, df.columns, name="_at", start=0)
    return (placed.join(draws, "_at").withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select(*df.columns))


#: Beyond this mean a Poisson draw is the sum of draws of equal smaller means, each exact to doubles.
POISSON_MEAN = 200.0


def _poisson_steps(mean: float) -> list[float]:
    """Distribution function of a Poisson variable at 0, 1, ... until it reaches 1 in doubles."""
    steps, term, i = [], math.exp(-mean), 0
    total = term
    while total < 1.0 and (i < mean or term > 1e-18):
        steps.append(total)
        i += 1
        term *= mean / i
        total += term
    return steps


def sample_by_key(df: DataFrame, key: str, fractions: dict, seed: int = 6, with_replacement: bool = False) -> DataFrame:
    """Stratified sample (``sampleByKey``). With replacement every row of stratum ``k`` is
    repeated a Poisson(fraction_k) number of times: seeded uniforms, stored in columns of their
    own, are looked up in the stratum's distribution function. A mean above ``POISSON_MEAN`` is cut
    into equal parts, one uniform each, whose draws add up to the same distribution; means above
    ``64 * POISSON_MEAN`` are refused."""
    for k, f in fractions.items():
        if not 0 <= f <= (64 * POISSON_MEAN if with_replacement else 1):
            raise ValueError(f"fraction of {k!r} is {f}, out of range")
    if not with_replacement:
        return df.sampleBy(key, fractions, seed)
    parts = {k: max(1, math.ceil(f / POISSON_MEAN)) for k, f in fractions.items()}
    if not parts:
        return df.limit(0)
    steps = F.create_map(*[x for k, f in fractions.items() for x in
                           (F.lit(k), F.array(*[F.lit(c) for c in _poisson_steps(f / parts[k])]).cast("array<double>"))])
    drawn = df.withColumns({f"_u{i}": F.rand(seed + i) for i in range(max(parts.values()))})
    drawn = drawn.withColumn("_steps", steps[F.col(key)])
    drawn = drawn.withColumn("_parts", F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col(key)])

    def draw(i: int) -> Column:
        u = F.col(f"_u{i}")
        return F.when(F.col("_parts") > i, F.size(F.filter("_steps", lambda c: u >= c))).otherwise(0)

    draws = [draw(i) for i in range(max(parts.values()))]
    drawn = drawn.withColumn("_reps", F.when(F.col("_parts").isNotNull(), reduce(lambda a, b: a + b, draws)))
    return (drawn.where("_reps > 0").withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("_reps"))))
            .select(*df.columns))


def laid_out(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` partitions of a known layout: a row lies in partition ``key mod n`` (``repartitionById``),
    so what a partition holds is a matter of the data, not of the scheduler."""
    return df.repartitionById(n, F.pmod(F.col(key), F.lit(n)).cast("int"))


def contents(df: DataFrame, col: str, max_items: int = 10_000) -> DataFrame:
    """``glom``: what every physical partition of ``df`` holds, in its order, as arrays ``values`` of at
    most ``max_items`` elements (``partition``, ``chunk``). One pass over each partition, a batch of
    rows at a time: no shuffle, and no array or task holds a partition whole."""
    schema = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("chunk", T.LongType()),
                           T.StructField("values", T.ArrayType(df.schema[col].dataType))])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, chunk = TaskContext.get().partitionId(), None, 0

        def row(values):
            lists = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays([pa.array([here], pa.int32()), pa.array([chunk], pa.int64()), lists],
                                              names=schema.names)

        for batch in batches:
            new = batch.column(0)
            held = new if held is None else pa.concat_arrays([held, new])
            while len(held) >= max_items:
                yield row(held.slice(0, max_items))
                held, chunk = held.slice(max_items), chunk + 1
        if held is not None and len(held):
            yield row(held)

    return df.select(col).mapInArrow(chunks, schema)


def shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, rows ``n`` and ``share`` of all rows. The key columns are kept (memory, then executor
    disk) while the total and the groups are counted, and given back before this returns; lost
    partitions are read again. The groups' counts, small beside the rows, are stored."""
    kept = df.select(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = kept.count()
        counts = materialise(kept.groupBy(*keys).agg(F.count("*").alias("n")), "shares")
    finally:
        kept.unpersist(blocking=True)
    return counts.withColumn("share", F.round(F.col("n") / F.lit(total), 6))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition (``glom().map(len)``, ``getNumPartitions``)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def sorted_within_buckets(df: DataFrame, bucket: Column, n: int, order: list[str], pos: str = "pos") -> DataFrame:
    """``repartitionAndSortWithinPartitions``: rows go to partition ``bucket`` (an int in
    0..n-1) and are sorted inside it; ``pos`` is the 1-based position inside the partition.

    This is the literal physical layout (one task per bucket). For large data use
    ``positions_within_buckets``, which gives the same (bucket, position) answer with the
    skew-safe scan."""
    parted = df.withColumn("_b", bucket).repartitionById(n, F.col("_b")).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return parted.withColumn("partition", F.spark_partition_id()).withColumn(pos, mid + 1).drop("_b")


def positions_within_buckets(df: DataFrame, bucket: Column, order: list[str], bucket_name: str = "partition",
                             pos: str = "pos") -> DataFrame:
    """Bucket of every row and its 1-based position in the bucket's sort order — the logical
    result of ``repartitionAndSortWithinPartitions`` — as a running count per bucket, which
    spreads a bucket holding half of all rows over many tasks."""
    tagged = df.withColumn(bucket_name, bucket).withColumn("_one", F.lit(1))
    return running(tagged, [bucket_name], order, {pos: ("count", "_one")}).drop("_one")


def partial_sums(df: DataFrame, col: str) -> DataFrame:
    """``mapPartitions``: one (rows, sum) record per partition, computed with pandas on the
    Arrow batches of the partition (one running state per task)."""
    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = 0, 0.0
        for b in batches:
            n += len(b)
            s += float(b[col].sum())
        yield pd.DataFrame({"n": [n], "total": [s]})
    return df.select(col).mapInPandas(per_partition, "n long, total double")


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage by writing to the reliable checkpoint directory (shared storage);
    a lost executor re-reads the files instead of recomputing the plan."""
    return df.checkpoint(eager)
