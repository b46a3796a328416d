"""Window queries (WIN). Partitions by (returnflag, linestatus): six keys over all of
lineitem, i.e. every key is hot, which exercises the skew-safe two-level scan."""

from pyspark.sql import functions as F

from corvid.operators import sessions, windows
from corvid.plans.registry import query
from corvid.sources.tables import Tables

P = ["l_returnflag", "l_linestatus"]
BY_DATE = ["l_shipdate", "l_orderkey", "l_linenumber"]
BY_QTY = ["l_quantity desc", "l_orderkey", "l_linenumber"]
W_DATE = "PARTITION BY l_returnflag, l_linestatus ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
W_QTY = "PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity DESC, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
W_RANK = "PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity DESC"


def _li(spark, d):
    return Tables(spark, d).lineitem.select(*P, "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity",
                                            "l_extendedprice")


@query("win_running_max", sql=f"""
    SELECT l_orderkey, l_linenumber, max(l_extendedprice) OVER ({W_DATE}) AS running_max FROM lineitem""")
def win_running_max(spark, d):
    r = windows.running(_li(spark, d), P, BY_DATE, {"running_max": ("max", "l_extendedprice")})
    return r.select("l_orderkey", "l_linenumber", "running_max")


@query("win_running_avg", sql=f"""
    SELECT l_orderkey, l_linenumber, round(avg(l_quantity) OVER ({W_QTY}), 6) AS running_avg FROM lineitem""")
def win_running_avg(spark, d):
    r = windows.running(_li(spark, d), P, BY_QTY, {"running_avg": ("avg", "l_quantity")})
    return r.select("l_orderkey", "l_linenumber", F.round("running_avg", 6).alias("running_avg"))


@query("win_rank", sql=f"""
    SELECT l_orderkey, l_linenumber, CAST(rank() OVER ({W_RANK}) AS INTEGER) AS rank FROM lineitem""")
def win_rank(spark, d):
    return windows.ranks(_li(spark, d), P, ["l_quantity desc"], rank="rank", dense_rank=None) \
        .select("l_orderkey", "l_linenumber", "rank")


@query("win_dense_rank", sql=f"""
    SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER ({W_RANK}) AS INTEGER) AS dense_rank FROM lineitem""")
def win_dense_rank(spark, d):
    return windows.ranks(_li(spark, d), P, ["l_quantity desc"], rank=None, dense_rank="dense_rank") \
        .select("l_orderkey", "l_linenumber", "dense_rank")


@query("win_combined", sql=f"""
    SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity,
           max(l_quantity) OVER ({W_QTY}) AS max_qty,
           round(avg(l_quantity) OVER ({W_QTY}), 6) AS avg_qty,
           CAST(rank() OVER ({W_RANK}) AS INTEGER) AS rank,
           CAST(dense_rank() OVER ({W_RANK}) AS INTEGER) AS dense_rank
    FROM lineitem WHERE l_quantity IS NOT NULL""")
def win_combined(spark, d):
    li = _li(spark, d).where(F.col("l_quantity").isNotNull())
    r = windows.ranked_running(li, P, BY_QTY, {"max_qty": ("max", "l_quantity"), "avg_qty": ("avg", "l_quantity")})
    return r.select(*P, "l_orderkey", "l_linenumber", "l_quantity", "max_qty",
                    F.round("avg_qty", 6).alias("avg_qty"), "rank", "dense_rank")


@query("win_running_net", sql="""
    WITH h AS (SELECT date_trunc('hour', ts) AS hour,
                      sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS buys,
                      sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS sells
               FROM events GROUP BY 1)
    SELECT hour, round(buys, 2) AS buys, round(sells, 2) AS sells,
           round(sum(buys) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total_buys,
           round(sum(sells) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total_sells,
           round(sum(buys - sells) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS net
    FROM h""")
def win_running_net(spark, d):
    e = Tables(spark, d).events
    h = (e.groupBy(F.date_trunc("hour", "ts").alias("hour"))
         .agg(F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0)).alias("buys"),
              F.sum(F.when(F.col("event_type") == "click", F.col("value")).otherwise(0)).alias("sells"))
         .withColumn("diff", F.col("buys") - F.col("sells")))
    r = windows.running(h, [], ["hour"], {"total_buys": ("sum", "buys"), "total_sells": ("sum", "sells"),
                                         "net": ("sum", "diff")})
    return r.select("hour", *[F.round(c, 2).alias(c) for c in ["buys", "sells", "total_buys", "total_sells", "net"]])


@query("win_top1_per_group", sql="""
    SELECT year, o_orderkey, o_totalprice FROM (
      SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice,
             row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1""")
def win_top1_per_group(spark, d):
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    return windows.top_one_per_group(o, ["year"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])


@query("win_combined_split", sql=f"""
    SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity,
           max(l_quantity) OVER ({W_QTY}) AS max_qty,
           round(avg(l_quantity) OVER ({W_QTY}), 6) AS avg_qty,
           CAST(rank() OVER ({W_RANK}) AS INTEGER) AS rank,
           CAST(dense_rank() OVER ({W_RANK}) AS INTEGER) AS dense_rank
    FROM lineitem WHERE l_quantity IS NOT NULL""")
def win_combined_split(spark, d):
    """``win_combined`` with the skew-safe two-level scan forced for every key (the path taken
    when a key exceeds ``max_group_rows``)."""
    li = _li(spark, d).where(F.col("l_quantity").isNotNull())
    r = windows.ranked_running(li, P, BY_QTY, {"max_qty": ("max", "l_quantity"), "avg_qty": ("avg", "l_quantity")},
                               max_group_rows=0)
    return r.select(*P, "l_orderkey", "l_linenumber", "l_quantity", "max_qty",
                    F.round("avg_qty", 6).alias("avg_qty"), "rank", "dense_rank")


@query("win_sessions", sql="""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR
                                        THEN 0 ELSE 1 END AS new_session FROM events),
    s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, sid""")
def win_sessions(spark, d):
    """Sessions of each user, made per slice of time and merged at the slices' borders."""
    return sessions.sessions(Tables(spark, d).events, ["user_id"], "ts", "6 HOURS")
