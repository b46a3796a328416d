"""Window functions (WIN) that stay balanced when one partition key holds a large share of
the rows.

A plain ``Window.partitionBy(k).orderBy(o)`` sends every row of a key to one task. The
running aggregates here use a two-level scan instead:

1. ``repartitionByRange(keys, order)`` cuts the data into contiguous, sampled slices of
   similar size, so a hot key is spread over many partitions;
2. every slice computes its local running values and ranks (window over ``(keys, slice)``); the
   rows are stored with them and their slice number, because a second evaluation would sample
   other bounds;
3. only keys crossing a slice boundary need a carry from earlier slices. There are fewer
   such (key, slice) pairs than slices, so the carry table is bounded by the partition
   count and is broadcast back.

Ranks are derived from per-(key, order value) counts, which partial aggregation shrinks
before any shuffle; a running sum over those counts gives ``rank`` and ``dense_rank``.

A plain window is still the cheapest plan when no key is large. ``running`` and ``ranks``
therefore first count rows per key (a partial aggregate over the key columns only) and use
the single-shuffle ``Window`` when the largest key fits one task (``max_group_rows``); the
two-level scan is used beyond that, and always for windows without partition keys.

Order specs are strings: ``"col"`` or ``"col desc"``. Running frames are ROWS frames; give a
total order (add tie-breakers) for deterministic results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from corvid.session import materialise

_PID = "_slice"
_ALL = "_all"


def parse_order(spec: str | Column) -> tuple[str, bool] | Column:
    if isinstance(spec, Column):
        return spec
    parts = spec.split()
    asc = not (len(parts) > 1 and parts[1].lower() == "desc")
    return parts[0], asc


def order_cols(specs) -> list[Column]:
    out = []
    for s in specs:
        p = parse_order(s)
        if isinstance(p, Column):
            out.append(p)
        else:
            name, asc = p
            out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
    return out


def _order_names(specs) -> list[str]:
    names = []
    for s in specs:
        p = parse_order(s)
        if isinstance(p, Column):
            raise TypeError("rank columns need order specs given as names")
        names.append(p[0])
    return names


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


DEFAULT_MAX_GROUP_ROWS = 2_000_000


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Row count of the largest key (one partially aggregated pass over the key columns)."""
    top = df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0]
    return int(top or 0)


def _plain_ok(df: DataFrame, keys: list[str], max_group_rows: int | None) -> bool:
    if not keys:
        return False
    limit = DEFAULT_MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    return limit > 0 and largest_group(df, keys) <= limit


def _fn(fn: str, c: str) -> Column:
    return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}[fn](F.col(c))


def dense_index(df: DataFrame, order, name: str = "row_idx", start: int = 0) -> DataFrame:
    """Consecutive 0/1-based positions along ``order`` (``zipWithIndex``), distributed.

    One range shuffle; ``monotonically_increasing_id`` inside each sorted slice gives the
    local position; per-slice counts (one row per slice) become prefix offsets. The slices are
    stored once: evaluated per branch, the sampled range bounds would differ between branches.
    """
    cols = order_cols(order)
    ranged = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialise(ranged, "index-slices")
    local = F.col("_mid") - F.shiftleft(F.col(_PID).cast("long"), 33)
    counts = ranged.groupBy(_PID).agg(F.count("*").alias("_n"))
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = (ranged.join(F.broadcast(offsets), _PID)
           .withColumn(name, F.col("_off") + local + F.lit(start)))
    return out.drop(_PID, "_mid", "_off")


def _local_parts(aggs: dict[str, tuple[str, str]], w) -> dict[str, Column]:
    """What a slice computes by itself for the running aggregates."""
    parts = {}
    for out, (fn, c) in aggs.items():
        x = F.col(c)
        if fn in ("sum", "avg"):
            parts[f"_ls_{out}"] = F.sum(x).over(w)
        if fn in ("count", "avg"):
            parts[f"_lc_{out}"] = F.count(x).over(w)
        if fn == "max":
            parts[f"_lx_{out}"] = F.max(x).over(w)
        if fn == "min":
            parts[f"_ln_{out}"] = F.min(x).over(w)
    return parts


def _totals_and_carries(aggs: dict[str, tuple[str, str]], before) -> tuple[list[Column], list[Column]]:
    """Totals of a (key, slice), and what the slices before it carry over."""
    totals, carries = [], []
    for out, (fn, c) in aggs.items():
        x = F.col(c)
        if fn in ("sum", "avg"):
            totals.append(F.sum(x).alias(f"_ts_{out}"))
            carries.append(F.sum(f"_ts_{out}").over(before).alias(f"_cs_{out}"))
        if fn in ("count", "avg"):
            totals.append(F.count(x).alias(f"_tc_{out}"))
            carries.append(F.sum(f"_tc_{out}").over(before).alias(f"_cc_{out}"))
        if fn == "max":
            totals.append(F.max(x).alias(f"_tx_{out}"))
            carries.append(F.max(f"_tx_{out}").over(before).alias(f"_cx_{out}"))
        if fn == "min":
            totals.append(F.min(x).alias(f"_tn_{out}"))
            carries.append(F.min(f"_tn_{out}").over(before).alias(f"_cn_{out}"))
    return totals, carries


def _combined(aggs: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """Local and carried values put together."""
    final = {}
    for out, (fn, _c) in aggs.items():
        s, n = F.col(f"_ls_{out}"), F.col(f"_lc_{out}")
        if fn == "sum":
            final[out] = F.when(s.isNull(), F.col(f"_cs_{out}")).otherwise(s + F.coalesce(F.col(f"_cs_{out}"), F.lit(0)))
        elif fn == "count":
            final[out] = n + F.coalesce(F.col(f"_cc_{out}"), F.lit(0))
        elif fn == "max":
            final[out] = F.greatest(F.col(f"_lx_{out}"), F.col(f"_cx_{out}"))
        elif fn == "min":
            final[out] = F.least(F.col(f"_ln_{out}"), F.col(f"_cn_{out}"))
        else:
            total = F.coalesce(s, F.lit(0)) + F.coalesce(F.col(f"_cs_{out}"), F.lit(0))
            count = n + F.coalesce(F.col(f"_cc_{out}"), F.lit(0))
            final[out] = F.when(count > 0, total / count)
    return final


def running(df: DataFrame, partition_by: list[str], order, aggs: dict[str, tuple[str, str]],
            max_group_rows: int | None = None) -> DataFrame:
    """Running aggregates over ``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``.

    ``aggs`` maps an output name to ``(fn, column)``, ``fn`` in sum, count, min, max, avg.
    ``max_group_rows``: largest key size handled by a plain window (0 forces the two-level
    scan; default ``DEFAULT_MAX_GROUP_ROWS``). Sums of doubles are added slice by slice in the
    two-level scan, so their last digits may differ from the plain window's; take DECIMAL columns
    where they must not.
    """
    return ranked_running(df, partition_by, order, aggs, 0, None, None, max_group_rows)


def ranked_running(df: DataFrame, partition_by: list[str], order, aggs: dict[str, tuple[str, str]], rank_on: int = 1,
                   rank: str | None = "rank", dense_rank: str | None = "dense_rank",
                   max_group_rows: int | None = None) -> DataFrame:
    """``running`` along ``order``, and ``rank()`` and ``dense_rank()`` along its first ``rank_on`` columns,
    in one scan: the slices of the two-level scan are sorted, numbered and stored once.

    Across slices a rank needs three figures per key: the rows and distinct values before the
    slice, and the rank of the last value before it, which the slice may go on with.
    """
    for fn, _c in aggs.values():
        if fn not in ("sum", "count", "min", "max", "avg"):
            raise ValueError(f"unsupported running aggregate {fn}")
    order = list(order)
    ocols, rcols = order_cols(order), order_cols(order[:rank_on])
    if _plain_ok(df, list(partition_by), max_group_rows):
        rows = Window.partitionBy(*partition_by).orderBy(*ocols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        by_value = Window.partitionBy(*partition_by).orderBy(*rcols) if rank_on else None
        cols = {out: _fn(fn, c).over(rows) for out, (fn, c) in aggs.items()}
        if rank:
            cols[rank] = F.rank().over(by_value)
        if dense_rank:
            cols[dense_rank] = F.dense_rank().over(by_value)
        return df.withColumns(cols)
    keys = list(partition_by)
    base = df
    if not keys:
        base = df.withColumn(_ALL, F.lit(0))
        keys = [_ALL]

    # 1. contiguous slices; running values and ranks inside each (key, slice)
    ranged = (base.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *ocols)
              .withColumn(_PID, F.spark_partition_id()))
    here = Window.partitionBy(*keys, _PID)
    parts = _local_parts(aggs, here.orderBy(*ocols).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.struct(*[F.col(n) for n in _order_names(order[:rank_on])]) if rank_on else None
    if rank_on:
        parts |= {"_lr": F.rank().over(here.orderBy(*rcols)), "_ld": F.dense_rank().over(here.orderBy(*rcols))}
    local = materialise(ranged.withColumns(parts), "scan-slices")

    # 2. keys that cross a slice boundary: first key of a slice == last key of an earlier one
    kstruct = F.struct(*[F.col(k) for k in keys])
    bounds = local.groupBy(_PID).agg(F.min(kstruct).alias("_first"), F.max(kstruct).alias("_last"))
    prev_last = F.lag("_last").over(Window.orderBy(_PID))
    crossing = (bounds.withColumn("_prev", prev_last)
                .where(F.col("_prev") == F.col("_first"))
                .select(*[F.col("_first")[k].alias(k) for k in keys]).distinct())

    # 3. per-slice totals of crossing keys only (≤ 2 × slices rows), prefix over slices
    per_key = Window.partitionBy(*keys).orderBy(_PID)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    tot_exprs, carry_cols = _totals_and_carries(aggs, before)
    if rank_on:
        tot_exprs += [F.count("*").alias("_tn"), F.max("_ld").alias("_td"), F.max("_lr").alias("_tl"),
                      F.min_by(value, "_lr").alias("_tf"), F.max_by(value, "_lr").alias("_tz")]
    hot = local.join(F.broadcast(crossing), _null_safe_on(local, crossing, keys), "left_semi")
    totals = hot.groupBy(*keys, _PID).agg(*tot_exprs)
    if rank_on:
        goes_on = F.col("_tf").eqNullSafe(F.lag("_tz").over(per_key)) & (F.row_number().over(per_key) > 1)
        totals = totals.withColumn("_goes", goes_on.cast("int"))
        totals = totals.withColumn("_rows", F.coalesce(F.sum("_tn").over(before), F.lit(0)))
        # the rank of the slice's last value, unless that value began in an earlier slice
        totals = totals.withColumn("_begun", F.when((F.col("_goes") == 0) | (F.col("_td") > 1), F.col("_rows") + F.col("_tl")))
        carry_cols += [F.col("_rows").alias("_cr_n"), F.col("_goes").alias("_cr_goes"),
                       F.sum(F.col("_td") - F.col("_goes")).over(before).alias("_cr_d"),
                       F.last("_begun", ignorenulls=True).over(before).alias("_cr_last"),
                       F.when(F.col("_goes") == 1, F.col("_tf")).alias("_cr_value")]
    carries = (totals.select(*keys, _PID, *carry_cols, F.row_number().over(per_key).alias("_rn"))
               .where(F.col("_rn") > 1).drop("_rn"))
    carries = carries.select(*[F.col(k).alias(f"_ck_{k}") for k in keys], F.col(_PID).alias("_cpid"),
                             *[c for c in carries.columns if c.startswith("_c") and c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in keys]) & (F.col(_PID) == F.col("_cpid"))
    joined = local.join(F.broadcast(carries), cond, "left")

    # 4. combine local and carried values
    final = _combined(aggs)
    if rank:
        same = (F.col("_cr_goes") == 1) & value.eqNullSafe(F.col("_cr_value"))
        final[rank] = F.when(same, F.col("_cr_last")).otherwise(F.coalesce("_cr_n", F.lit(0)) + F.col("_lr")).cast("int")
    if dense_rank:
        final[dense_rank] = (F.coalesce("_cr_d", F.lit(0)) + F.col("_ld") - F.coalesce("_cr_goes", F.lit(0))).cast("int")
    return joined.withColumns(final).select(*df.columns, *final)


def ranks(df: DataFrame, partition_by: list[str], order, rank: str | None = "rank",
          dense_rank: str | None = "dense_rank", max_group_rows: int | None = None) -> DataFrame:
    """``rank()`` and ``dense_rank()`` over ``partition_by`` ordered by ``order``.

    Rows are first counted per distinct (key, order value) — partial aggregation collapses
    a hot key's repeated values map-side. A running sum of those counts (skew-safe
    ``running``) gives the number of rows before each value; the result is joined back on
    (key, order value) null-safely, where AQE splits a hot join partition.
    """
    keys = list(partition_by)
    if _plain_ok(df, keys, max_group_rows):
        w = Window.partitionBy(*keys).orderBy(*order_cols(order))
        cols = {}
        if rank:
            cols[rank] = F.rank().over(w)
        if dense_rank:
            cols[dense_rank] = F.dense_rank().over(w)
        return df.withColumns(cols)
    onames = _order_names(order)
    dims = keys + [c for c in onames if c not in keys]
    counts = df.groupBy(*dims).agg(F.count("*").alias("_cnt"), F.lit(1).alias("_one"))
    cum = running(counts, keys, order, {"_upto": ("sum", "_cnt"), "_dense": ("sum", "_one")},
                  max_group_rows=max_group_rows)
    sel = [F.col(c).alias(f"_rk_{c}") for c in dims]
    if rank:
        sel.append((F.col("_upto") - F.col("_cnt") + 1).alias(rank))
    if dense_rank:
        sel.append(F.col("_dense").cast("int").alias(dense_rank))
    cum = cum.select(*sel)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_rk_{c}")) for c in dims])
    out = df.join(cum, cond, "inner")
    if rank:
        out = out.withColumn(rank, F.col(rank).cast("int"))
    return out.drop(*[f"_rk_{c}" for c in dims])


def top_one_per_group(df: DataFrame, group_by: list[str], order_col: str, tiebreak: str,
                      cols: list[str]) -> DataFrame:
    """Row with the greatest ``order_col`` per group (smallest ``tiebreak`` among ties).

    ``max_by`` is an ordinary aggregate: partial aggregation keeps one candidate per group
    and task, so no group is ever sorted or gathered whole. A tiebreak that can't be negated
    (strings, dates) is settled by a first aggregate per (group, order value).
    """
    row = F.struct(*[F.col(c) for c in cols])
    if isinstance(df.schema[tiebreak].dataType, NumericType):
        best = F.max_by(row, F.struct(F.col(order_col), (-F.col(tiebreak)).alias("_tb"))).alias("_best")
        top = df.groupBy(*group_by).agg(best)
    else:
        first = df.groupBy(*group_by, F.col(order_col).alias("_o")).agg(F.min_by(row, tiebreak).alias("_first"))
        top = first.groupBy(*group_by).agg(F.max_by("_first", "_o").alias("_best"))
    return top.select(*group_by, *[F.col("_best")[c].alias(c) for c in cols])
