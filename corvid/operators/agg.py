"""Aggregation (AGG): grouped and global aggregates, grouping sets, pivot, bounded collects.

All aggregates here are declarative ``groupBy().agg()``: Spark runs a partial aggregate
in every map task before the shuffle, so a hot key costs one row per task, not one task.
The exception is collecting values into arrays, which cannot be combined map-side; the
``collect_bounded`` operator splits large groups into bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from corvid.operators.windows import running


def grouping_sets(df: DataFrame, sets: list[list[str]], aggs: list[Column],
                  gid: str | None = "gid") -> DataFrame:
    """``GROUP BY GROUPING SETS (...)``; ``grouping_id()`` tells a subtotal NULL from a data NULL."""
    cols = sorted({c for s in sets for c in s}, key=lambda c: [c in s for s in sets].index(True))
    extra = [F.grouping_id(*cols).alias(gid)] if gid else []
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(*aggs, *extra)


def rollup(df: DataFrame, cols: list[str], aggs: list[Column], gid: str = "gid") -> DataFrame:
    return df.rollup(*cols).agg(*aggs, F.grouping_id(*cols).alias(gid))


def cube(df: DataFrame, cols: list[str], aggs: list[Column], gid: str = "gid") -> DataFrame:
    return df.cube(*cols).agg(*aggs, F.grouping_id(*cols).alias(gid))


def pivot_sum(df: DataFrame, group_by: list[str], pivot_col: str, values: list, measure: str,
              agg: str = "sum") -> DataFrame:
    """Pivot with an explicit value list (no extra job to discover the distinct values and
    a fixed output schema)."""
    return df.groupBy(*group_by).pivot(pivot_col, values).agg(getattr(F, agg)(measure))


def pivot_sums(df: DataFrame, group_by: list[str], pivot_col: str, values: list[str],
               measures: list[str] | None = None, other: str = "other") -> DataFrame:
    """Pivot with the sums of several measures, by default of all numeric columns: columns
    ``value_measure``. Rows of a value that isn't listed, or of none, go to ``other``."""
    if measures is None:
        measures = [f.name for f in df.schema.fields
                    if isinstance(f.dataType, NumericType) and f.name not in (*group_by, pivot_col)]
    label = F.when(F.col(pivot_col).isin(values), F.col(pivot_col)).otherwise(other)
    out = (df.withColumn(pivot_col, label).groupBy(*group_by).pivot(pivot_col, [*values, other])
           .agg(*[F.sum(m).alias(m) for m in measures]))
    if len(measures) == 1:  # Spark leaves the name of a single measure out
        out = out.withColumnsRenamed({v: f"{v}_{measures[0]}" for v in (*values, other)})
    return out


def population_moments(x: str, prefix: str = "") -> list[Column]:
    """Population skewness and excess kurtosis (the definitions Spark's built-ins use)."""
    return [F.skewness(x).alias(f"{prefix}skewness"), F.kurtosis(x).alias(f"{prefix}kurtosis")]


def collect_bounded(df: DataFrame, keys: list[str], value: str | Column, max_items: int = 10000,
                    distinct: bool = False, out: str = "values", sets: dict[str, str] | None = None,
                    max_group_rows: int | None = None) -> DataFrame:
    """Per key, the sorted values as arrays of at most ``max_items`` elements.

    Chunk ``c`` of a key holds the values at positions ``c * max_items`` up to
    ``(c + 1) * max_items`` of its sorted values (nulls first; they count in ``n`` but not in
    the array), at every size of data. Positions come from the skew-safe running count, so no
    task or row holds an unbounded list, also when a hot key has few distinct values.
    ``sets`` maps an output name to a column whose distinct values are collected per chunk.
    Output: ``keys..., chunk, n, values, sets...``.
    """
    v = F.col(value) if isinstance(value, str) else value
    sets = sets or {}
    base = df.select(*keys, v.alias("_v"), *[F.col(c).alias(f"_set_{n}") for n, c in sets.items()])
    if distinct:
        base = base.distinct()
    order = ["_v"] + [f"_set_{n}" for n in sets]
    placed = running(base.withColumn("_one", F.lit(1)), keys, order, {"_pos": ("count", "_one")},
                     max_group_rows=max_group_rows)
    chunk = F.floor((F.col("_pos") - 1) / F.lit(max_items)).cast("long")
    return (placed.withColumn("chunk", chunk).groupBy(*keys, "chunk")
            .agg(F.count("*").alias("n"), F.sort_array(F.collect_list("_v")).alias(out),
                 *[F.sort_array(F.collect_set(f"_set_{n}")).alias(n) for n in sets]))
