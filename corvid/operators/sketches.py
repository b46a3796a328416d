"""Mergeable distinct-count sketches (AGG-03): one stored per slice and key, united later.

A HyperLogLog sketch of a slice (a day, a load) is a few hundred bytes to a few kilobytes however
many rows it has seen; sketches unite without error beyond their own. So distinct counts over any set
of slices read the stored sketches and never the rows again, and a slice that arrives late or
is loaded again replaces its own sketches only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import scratch_path


def lg_k(rsd: float) -> int:
    """Smallest sketch size (log2 of its registers, 4 to 21) whose relative standard deviation,
    1.04 / sqrt(registers), is at most ``rsd``."""
    if not 0 < rsd < 1:
        raise ValueError(f"relative standard deviation {rsd}")
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def store(df: DataFrame, path: str, slice_col: str, keys: list[str], value: str, rsd: float = 0.02) -> str:
    """Write a sketch of ``value`` per (slice, ``keys``) below ``path``, in a folder per slice. Slices
    in ``df`` replace those stored before; others stay. NULL values count for nothing. Rows of a key are
    sketched in each task before the shuffle, so a hot key costs a sketch per task."""
    sketched = df.groupBy(slice_col, *keys).agg(F.hll_sketch_agg(value, F.lit(lg_k(rsd))).alias("sketch"))
    (sketched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slice_col).parquet(path))
    return path


def estimates(spark: SparkSession, path: str, keys: list[str], where: Column | None = None,
              out: str = "distinct_values") -> DataFrame:
    """Estimated distinct values per ``keys`` over the stored slices, or those of ``where`` (a condition
    on the slice column reads their folders only)."""
    sketches = spark.read.parquet(path)
    if where is not None:
        sketches = sketches.where(where)
    united = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias(out))


def within(estimate: Column, exact: Column, rsd: float, sigmas: float = 3.0) -> Column:
    """Whether an estimate lies within ``sigmas`` standard deviations of the exact count."""
    return F.abs(estimate - exact) <= exact * F.lit(rsd * sigmas)


def stored_estimates(df: DataFrame, slice_col: str, keys: list[str], value: str, rsd: float = 0.02,
                     out: str = "distinct_values") -> DataFrame:
    """``estimates`` over sketches of ``df`` stored below the scratch folder."""
    path = store(df, scratch_path(df.sparkSession, "sketches"), slice_col, keys, value, rsd)
    return estimates(df.sparkSession, path, keys, out=out)
