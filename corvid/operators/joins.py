"""Joins (JN).

Join strategy is left to Catalyst and AQE: a side is broadcast only when its size is known
to be small (file statistics under ``spark.sql.autoBroadcastJoinThreshold``, or AQE's
runtime sizes), otherwise sort-merge with AQE splitting skewed partitions. Outer joins are
decomposed into an inner join plus anti joins (``outer_join``) because AQE cannot split a
hot key on the non-preserved side; semi and anti joins probe the other side's distinct
keys. The operators below pre-aggregate to one row per key before joining wherever only
per-key figures are needed, so a hot key never multiplies across the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.agg import collect_bounded
from corvid.operators.windows import dense_index


def _keys(left_keys, right_keys):
    lk = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    rk = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    if len(lk) != len(rk):
        raise ValueError("left and right key lists differ in length")
    return lk, rk


def _distinct_keys(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    # partial aggregation collapses a hot key map-side before the shuffle
    return df.select(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]).distinct()


def _unmatched(df: DataFrame, keys: list[str], other: DataFrame, other_keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key has no partner in ``other`` (NULL keys never match)."""
    dk = _distinct_keys(other, other_keys, "_uk")
    cond = reduce(lambda a, b: a & b, [df[k] == dk[f"_uk{i}"] for i, k in enumerate(keys)])
    return df.join(dk, cond, "left_anti")


def outer_join(left: DataFrame, right: DataFrame, left_keys, right_keys, how: str,
               using: bool = False, unique: bool = False) -> DataFrame:
    """Left, right or full outer equi-join that tolerates a hot key on either side.

    AQE splits skewed partitions only on the preserved side of a left/right outer join and
    not at all for a full outer join. The same rows are produced as the inner join (AQE can
    split either side) plus, per preserved side, its rows without partner — an anti join
    against the other side's distinct keys. With ``using`` the key columns are merged as in
    ``JOIN ... USING``; otherwise both key columns are kept (NULL on the unmatched side).

    ``unique``: no key repeats on either side (one row per key, as after ``groupBy``), so no key
    is hot and Spark's own outer join reads each side once.
    """
    how = {"left_outer": "left", "right_outer": "right", "outer": "full", "full_outer": "full"}.get(how, how)
    if how not in ("left", "right", "full"):
        raise ValueError(f"not an outer join: {how}")
    lk, rk = _keys(left_keys, right_keys)
    if using:
        if lk != rk:
            raise ValueError("USING joins need the same key names on both sides")
        on = lk
    else:
        on = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in zip(lk, rk)])
    if unique:
        return left.join(right, on, how)
    matched = left.join(right, on, "inner")
    parts = [matched]
    if how in ("left", "full"):
        parts.append(_unmatched(left, lk, right, rk))
    if how in ("right", "full"):
        parts.append(_unmatched(right, rk, left, lk))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*matched.columns)


def equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
              unique: bool = False) -> DataFrame:
    """Join on an expression; both key columns are kept. Outer joins go through the
    skew-tolerant ``outer_join``."""
    if how in ("left", "right", "full", "left_outer", "right_outer", "outer", "full_outer"):
        return outer_join(left, right, left_key, right_key, how, unique=unique)
    return left.join(right, F.col(left_key) == F.col(right_key), how)


def join_using(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``USING`` join: one key column in the output (coalesced for full outer joins)."""
    if how in ("left", "right", "full", "left_outer", "right_outer", "outer", "full_outer"):
        return outer_join(left, right, keys, keys, how, using=True)
    return left.join(right, keys, how)


def full_outer_using(left: DataFrame, right: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """``FULL OUTER JOIN ... USING (keys)`` that tolerates a hot key (see ``outer_join``)."""
    return outer_join(left, right, keys, keys, "full", using=True, unique=unique)


def full_outer_chain(dfs: list[DataFrame], key: str, unique: bool = False) -> DataFrame:
    """Chained full outer USING joins: the key column is the coalesce of all sides."""
    return reduce(lambda a, b: full_outer_using(a, b, [key], unique), dfs)


def dimension_with_counts(dim: DataFrame, dim_key: str, facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Left-join a dimension to several per-key counts of fact rows.

    ``facts`` maps an output column to ``(fact_df, fact_key)``. Each fact is counted per
    key first (partial aggregation), so the joins see one row per key; dimension rows
    without facts keep NULL counts.
    """
    out = dim
    for name, (fact, key) in facts.items():
        counts = fact.groupBy(F.col(key).alias(f"_k_{name}")).agg(F.count("*").alias(name))
        out = out.join(counts, F.col(dim_key) == F.col(f"_k_{name}"), "left").drop(f"_k_{name}")
    return out


def cogroup_stats(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """``cogroup`` reduced to per-side sizes and sums: each side is aggregated per key,
    then full-outer joined (one row per key and side), absent sides count zero."""
    a = left.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("left_n"), F.sum(left_value).alias("left_sum"))
    b = right.groupBy(F.col(key if key in right.columns else right.columns[0]).alias("k")) \
        .agg(F.count("*").alias("right_n"), F.sum(right_value).alias("right_sum"))
    # one row per key and side, so no key is hot; NULL keys form one group as in cogroup
    b = b.withColumnRenamed("k", "_k")
    return (a.join(b, a["k"].eqNullSafe(b["_k"]), "full_outer")
            .select(F.coalesce("k", "_k").alias("k"), F.coalesce("left_n", F.lit(0)).alias("left_n"), "left_sum",
                    F.coalesce("right_n", F.lit(0)).alias("right_n"), "right_sum"))


def cogroup_lists(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                  right_key: str | None = None, max_items: int = 10_000) -> DataFrame:
    """``cogroup`` with both value lists: ``k``, ``chunk``, ``left_n``, ``left_values``, ``right_n``,
    ``right_values``.

    Chunk ``c`` of a key holds, of either side, the values at positions ``c * max_items`` onwards of
    the key's sorted values, so a key has as many rows as its longer list needs and no row or task
    holds an unbounded list. The sides meet on (key, chunk), which is unique on both, so no key is hot
    in the join. A side without the key, or without so many values, gives 0 and an empty list.
    NULL keys are one key; NULL values count in ``n`` but are in no list."""
    def chunks(df, k, value, side):
        lists = collect_bounded(df.select(F.col(k).alias("k"), F.col(value).alias("v")), ["k"], "v", max_items)
        return lists.select(F.col("k").alias(f"_k_{side}"), F.col("chunk").alias(f"_c_{side}"),
                            F.col("n").alias(f"{side}_n"), F.col("values").alias(f"{side}_values"))

    a, b = chunks(left, key, left_value, "left"), chunks(right, right_key or key, right_value, "right")
    both = a.join(b, a["_k_left"].eqNullSafe(b["_k_right"]) & (a["_c_left"] == b["_c_right"]), "full_outer")
    out = [F.coalesce("_k_left", "_k_right").alias("k"), F.coalesce("_c_left", "_c_right").alias("chunk")]
    for side in ("left", "right"):
        empty = F.array().cast(both.schema[f"{side}_values"].dataType)
        out += [F.coalesce(f"{side}_n", F.lit(0)).alias(f"{side}_n"),
                F.coalesce(f"{side}_values", empty).alias(f"{side}_values")]
    return both.select(*out)


def zip_by_position(left: DataFrame, right: DataFrame, left_order: list, right_order: list,
                    index: str = "idx") -> DataFrame:
    """Pair the i-th row of each side along explicit orders (``zip``).

    Both sides get a distributed dense index; the pairs are an equi-join on it (rows
    beyond the shorter side have no partner and are dropped, as ``zip`` requires equal
    lengths)."""
    a = dense_index(left, left_order, index)
    b = dense_index(right, right_order, index)
    return a.join(b, index)


def join_no_duplicates(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """USING join followed by removal of duplicate rows."""
    return left.join(right, keys, how).dropDuplicates()


def semi(left: DataFrame, right: DataFrame, left_keys, right_keys) -> DataFrame:
    """Rows of ``left`` with a partner in ``right`` (EXISTS), against the distinct right keys."""
    lk, rk = _keys(left_keys, right_keys)
    dk = _distinct_keys(right, rk, "_sk")
    return left.join(dk, reduce(lambda a, b: a & b, [left[k] == dk[f"_sk{i}"] for i, k in enumerate(lk)]),
                     "left_semi")


def anti(left: DataFrame, right: DataFrame, left_keys, right_keys) -> DataFrame:
    """Rows of ``left`` without partner in ``right`` (NOT EXISTS), against the distinct right keys."""
    lk, rk = _keys(left_keys, right_keys)
    return _unmatched(left, lk, right, rk)
