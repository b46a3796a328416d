"""Sort, limit, top-k and set operations (ORD, SET)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, order: list[Column | str]) -> DataFrame:
    """First ``k`` rows of a total order: ``orderBy().limit()`` plans as
    TakeOrderedAndProject (per-partition heaps of size k, then one merge), never a full sort."""
    return df.orderBy(*order).limit(k)


def sort_rows(df: DataFrame, order: list[Column | str], position: str | None = None) -> DataFrame:
    """Global sort. With ``position`` the 1-based rank in the order is materialised as a
    column (computed by the distributed dense index, not a single-task window)."""
    from corvid.operators.windows import dense_index
    if position is None:
        return df.orderBy(*order)
    return dense_index(df, order, position, start=1)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (no shuffle: partitions are concatenated)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def intersect_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct key tuples present in both inputs (set intersection).

    Each side is reduced to distinct keys first (partial aggregation before the shuffle),
    then a left-semi join keeps the common ones.
    """
    left = a.select(*keys).distinct()
    right = b.select(*keys).distinct()
    return left.join(right, keys, "left_semi")
