"""Session intervals of a batch table (the batch form of STR-10), also under a hot key.

A session is a run of a key's rows each less than ``gap`` after the one before. Rows are cut into
slices by (key, time), so a hot key spreads over many; each slice makes its own intervals. Two
intervals merge only across a slice border, where a key's last interval of one slice and its first of
the next lie less than ``gap`` apart, so only these are brought together: at most two rows per key
and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.session import discard, materialise

_SLICE, _SID = "_slice", "_sid"


def _numbered(df: DataFrame, keys: list[str], start: Column, before: Column, gap: str, order: list) -> DataFrame:
    """``df`` with the number of its session among the rows of ``keys``: a new one wherever ``start`` is
    not less than ``gap`` after ``before`` (of the rows before)."""
    rows = Window.partitionBy(*keys).orderBy(*order)
    joins = start < F.max(before).over(rows.rowsBetween(Window.unboundedPreceding, -1)) + F.expr(f"INTERVAL {gap}")
    opened = df.withColumn("_new", F.when(joins, 0).otherwise(1))
    return opened.withColumn(_SID, F.sum("_new").over(rows.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def sessions(df: DataFrame, keys: list[str], ts: str, gap: str, slices: int | None = None) -> DataFrame:
    """``keys``, ``start``, ``last`` (times of the first and last row) and ``n`` of every session. Rows
    without a time are in none; NULL keys are one key. ``slices``: how many (by default the session's
    shuffle partitions)."""
    times = df.select(*keys, F.col(ts).alias("_ts")).where("_ts IS NOT NULL")
    by = [*(F.col(k).asc_nulls_first() for k in keys), F.col("_ts")]
    sliced = times.repartitionByRange(slices, *by) if slices else times.repartitionByRange(*by)
    sliced = materialise(sliced.withColumn(_SLICE, F.spark_partition_id()), "session-slices")
    own = [*keys, _SLICE]
    local = (_numbered(sliced, own, F.col("_ts"), F.col("_ts"), gap, ["_ts"]).groupBy(*own, _SID)
             .agg(F.min("_ts").alias("start"), F.max("_ts").alias("last"), F.count("*").alias("n")))
    local = local.withColumn("_edge", (F.col(_SID) == 1) | (F.col(_SID) == F.max(_SID).over(Window.partitionBy(*own))))
    local = materialise(local, "session-parts")
    discard(sliced)
    merged = (_numbered(local.where("_edge").drop(_SID), keys, F.col("start"), F.col("last"), gap, ["start", "last"])
              .groupBy(*keys, _SID).agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n")))
    columns = [*keys, "start", "last", "n"]
    return local.where("NOT _edge").select(*columns).unionByName(merged.select(*columns))
