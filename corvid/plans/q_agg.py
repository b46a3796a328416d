"""Aggregation queries (AGG)."""

from pyspark.sql import functions as F

from corvid.functions.numeric import exact_money_sum, money
from corvid.operators import agg, sketches
from corvid.operators.jobs import net_revenue
from corvid.operators.joins import equi_join
from corvid.plans.registry import query
from corvid.sources.tables import Tables


@query("agg_count", sql="""
    SELECT c.c_mktsegment, count(*) AS n_rows, count(o.o_orderkey) AS n_orders
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_mktsegment""")
def agg_count(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_custkey", "o_orderkey")
    j = equi_join(t.customer, o, "c_custkey", "o_custkey", "left")
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("n_rows"), F.count("o_orderkey").alias("n_orders"))


@query("agg_count_distinct", sql="""
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts
    FROM lineitem GROUP BY l_returnflag""")
def agg_count_distinct(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("n_orders"), F.count_distinct("l_partkey").alias("n_parts"))


@query("agg_approx_distinct", sql="""
    SELECT event_type, count(DISTINCT user_id) AS exact_users, TRUE AS within_bound FROM events GROUP BY event_type""")
def agg_approx_distinct(spark, d):
    """HyperLogLog++ with 10% relative standard deviation beside the exact count."""
    users = Tables(spark, d).events.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.1).alias("approx_users"),
        F.count_distinct("user_id").alias("exact_users"))
    return users.select("event_type", "exact_users",
                        sketches.within(F.col("approx_users"), F.col("exact_users"), 0.1).alias("within_bound"))


@query("agg_sketch_union", sql="""
    SELECT l_returnflag, count(DISTINCT l_partkey) AS exact_parts, TRUE AS within_bound
    FROM lineitem GROUP BY l_returnflag""")
def agg_sketch_union(spark, d):
    """Sketches stored per month of shipping and united over all months, beside the exact count."""
    li = Tables(spark, d).lineitem.select("l_returnflag", "l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    estimated = sketches.stored_estimates(li, "month", ["l_returnflag"], "l_partkey", rsd=0.02, out="parts")
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("exact_parts"))
    both = estimated.join(exact, "l_returnflag")
    return both.select("l_returnflag", "exact_parts",
                       sketches.within(F.col("parts"), F.col("exact_parts"), 0.02).alias("within_bound"))


@query("agg_first_last", sql="""
    SELECT o_custkey, first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS first_order,
           last(o_orderkey ORDER BY o_orderdate, o_orderkey) AS last_order
    FROM orders GROUP BY o_custkey""")
def agg_first_last(spark, d):
    key = F.struct("o_orderdate", "o_orderkey")
    return Tables(spark, d).orders.groupBy("o_custkey").agg(
        F.min_by("o_orderkey", key).alias("first_order"), F.max_by("o_orderkey", key).alias("last_order"))


@query("agg_min_max", sql="""
    SELECT l_returnflag, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_returnflag""")
def agg_min_max(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_returnflag").agg(
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


@query("agg_sum", sql="""
    SELECT sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price FROM lineitem""")
def agg_sum(spark, d):
    return Tables(spark, d).lineitem.agg(F.sum("l_quantity").alias("sum_qty"),
                                         F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


@query("agg_sum_distinct", sql="""
    SELECT l_linestatus, sum(DISTINCT l_quantity) AS sum_distinct_qty FROM lineitem GROUP BY l_linestatus""")
def agg_sum_distinct(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_linestatus").agg(F.sum_distinct("l_quantity").alias("sum_distinct_qty"))


@query("agg_avg", sql="SELECT l_returnflag, round(avg(l_discount), 6) AS avg_disc FROM lineitem GROUP BY l_returnflag")
def agg_avg(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_discount"), 6).alias("avg_disc"))


@query("agg_var", sql="""
    SELECT l_returnflag, round(var_pop(l_quantity), 6) AS var_pop, round(stddev_pop(l_quantity), 6) AS stddev_pop,
           round(var_samp(l_quantity), 6) AS var_samp, round(stddev_samp(l_quantity), 6) AS stddev_samp
    FROM lineitem GROUP BY l_returnflag""")
def agg_var(spark, d):
    q = "l_quantity"
    return Tables(spark, d).lineitem.groupBy("l_returnflag").agg(
        F.round(F.var_pop(q), 6).alias("var_pop"), F.round(F.stddev_pop(q), 6).alias("stddev_pop"),
        F.round(F.var_samp(q), 6).alias("var_samp"), F.round(F.stddev_samp(q), 6).alias("stddev_samp"))


@query("agg_moments", sql="""
    WITH m AS (SELECT l_returnflag AS g, avg(l_quantity) AS mu FROM lineitem GROUP BY l_returnflag),
    c AS (SELECT l.l_returnflag AS g, avg(power(l.l_quantity - m.mu, 2)) AS m2,
                 avg(power(l.l_quantity - m.mu, 3)) AS m3, avg(power(l.l_quantity - m.mu, 4)) AS m4
          FROM lineitem l JOIN m ON l.l_returnflag = m.g GROUP BY l.l_returnflag)
    SELECT g AS l_returnflag, round(m3 / power(m2, 1.5), 6) AS skewness,
           round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM c""")
def agg_moments(spark, d):
    return (Tables(spark, d).lineitem.groupBy("l_returnflag").agg(*agg.population_moments("l_quantity", "_"))
            .select("l_returnflag", F.round("_skewness", 6).alias("skewness"),
                    F.round("_kurtosis", 6).alias("kurtosis")))


@query("agg_corr", sql="""
    SELECT l_linestatus, round(corr(l_quantity, l_extendedprice), 6) AS corr,
           round(covar_samp(l_quantity, l_discount), 8) AS covar_samp,
           round(covar_pop(l_quantity, l_discount), 8) AS covar_pop
    FROM lineitem GROUP BY l_linestatus""")
def agg_corr(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_linestatus").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"),
        F.round(F.covar_samp("l_quantity", "l_discount"), 8).alias("covar_samp"),
        F.round(F.covar_pop("l_quantity", "l_discount"), 8).alias("covar_pop"))


@query("agg_group_count", sql="SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority")
def agg_group_count(spark, d):
    return Tables(spark, d).orders.groupBy("o_orderpriority").count().orderBy(F.col("count").desc())


@query("agg_group_sum", sql="SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def agg_group_sum(spark, d):
    return Tables(spark, d).orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


Q1_SQL = """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
           CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))
                          * (1 + CAST(l_tax AS DECIMAL(12,2)))), 2) AS DOUBLE) AS sum_charge,
           round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
           round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
    FROM lineitem GROUP BY l_returnflag, l_linestatus"""


@query("agg_group_multi", sql=Q1_SQL)
def agg_group_multi(spark, d):
    li = Tables(spark, d).lineitem
    disc = net_revenue()
    return (li.groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("sum_qty"),
                 F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
                 F.round(F.sum(disc), 4).alias("sum_disc_price"),
                 exact_money_sum(money("l_extendedprice") * (1 - money("l_discount")) * (1 + money("l_tax")))
                 .alias("sum_charge"),
                 F.round(F.expr("avg(l_quantity)"), 6).alias("avg_qty"),
                 F.round(F.expr("avg(l_extendedprice)"), 4).alias("avg_price"),
                 F.round(F.avg("l_discount"), 6).alias("avg_disc"),
                 F.count("*").alias("count_order"))
            .orderBy("l_returnflag", "l_linestatus"))


@query("agg_group_avg", sql="SELECT p_brand, round(avg(p_retailprice), 6) AS avg_price FROM part GROUP BY p_brand")
def agg_group_avg(spark, d):
    return (Tables(spark, d).part.groupBy("p_brand").avg("p_retailprice")
            .select("p_brand", F.round("avg(p_retailprice)", 6).alias("avg_price")))


@query("agg_collect", sql="""
    SELECT l_orderkey, chunk, count(*) AS n,
           coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber), '') AS line_list,
           coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag), '') AS flag_set
    FROM (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST,
                                        l_returnflag NULLS FIRST) - 1) // 10000 AS chunk FROM lineitem)
    GROUP BY l_orderkey, chunk""")
def agg_collect(spark, d):
    li = Tables(spark, d).lineitem
    lists = agg.collect_bounded(li, ["l_orderkey"], "l_linenumber", out="lines", sets={"flags": "l_returnflag"})
    return lists.select("l_orderkey", "chunk", "n",
                        F.concat_ws(",", F.col("lines").cast("array<string>")).alias("line_list"),
                        F.concat_ws(",", "flags").alias("flag_set"))


@query("agg_grouping_sets", sql="""
    SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority))""")
def agg_grouping_sets(spark, d):
    return agg.grouping_sets(Tables(spark, d).orders, [["o_orderstatus", "o_orderpriority"]],
                             [F.round(F.sum("o_totalprice"), 2).alias("total")], gid=None)


@query("agg_grouping_sets_total", sql="""
    SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total, count(*) AS n,
           grouping_id(o_orderstatus, o_orderpriority) AS gid
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), ())""")
def agg_grouping_sets_total(spark, d):
    return agg.grouping_sets(Tables(spark, d).orders, [["o_orderstatus", "o_orderpriority"], []],
                             [F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n")])


@query("agg_grouping_sets_multi", sql="""
    SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total,
           grouping_id(o_orderstatus, o_orderpriority) AS gid
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())""")
def agg_grouping_sets_multi(spark, d):
    return agg.grouping_sets(Tables(spark, d).orders,
                             [["o_orderstatus"], ["o_orderpriority"], ["o_orderstatus", "o_orderpriority"], []],
                             [F.round(F.sum("o_totalprice"), 2).alias("total")])


def _orders_by_year(spark, d):
    return Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))


@query("agg_rollup", sql="""
    SELECT year, o_orderstatus, round(sum(o_totalprice), 2) AS total, grouping_id(year, o_orderstatus) AS gid
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, * FROM orders)
    GROUP BY ROLLUP (year, o_orderstatus)""")
def agg_rollup(spark, d):
    return agg.rollup(_orders_by_year(spark, d), ["year", "o_orderstatus"],
                      [F.round(F.sum("o_totalprice"), 2).alias("total")])


@query("agg_rollup_subtotals", sql="""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY year(o_orderdate)""")
def agg_rollup_subtotals(spark, d):
    r = agg.rollup(_orders_by_year(spark, d), ["year", "o_orderstatus"],
                   [F.round(F.sum("o_totalprice"), 2).alias("total")])
    # subtotal rows are told apart from data NULLs by grouping_id, not by IS NULL
    return r.where(F.col("gid") == 1).select("year", "total")


@query("agg_cube", sql="""
    SELECT year, o_orderstatus, round(sum(o_totalprice), 2) AS total, grouping_id(year, o_orderstatus) AS gid
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, * FROM orders)
    GROUP BY CUBE (year, o_orderstatus)""")
def agg_cube(spark, d):
    return agg.cube(_orders_by_year(spark, d), ["year", "o_orderstatus"],
                    [F.round(F.sum("o_totalprice"), 2).alias("total")])


@query("agg_pivot", sql="""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS F,
           round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS O,
           round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS P
    FROM orders GROUP BY year(o_orderdate)""")
def agg_pivot(spark, d):
    p = agg.pivot_sum(_orders_by_year(spark, d), ["year"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return p.select("year", *[F.round(c, 2).alias(c) for c in ["F", "O", "P"]])


_PIVOT_ALL = ",\n           ".join(
    f"CAST(sum(CASE WHEN {cond} THEN {m} END) AS BIGINT) AS {v}_{m}"
    for v, cond in (("F", "o_orderstatus = 'F'"), ("O", "o_orderstatus = 'O'"),
                    ("other", "o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')"))
    for m in ("o_orderkey", "o_custkey"))


@query("agg_pivot_all", sql=f"""
    SELECT o_orderpriority,
           {_PIVOT_ALL}
    FROM orders GROUP BY o_orderpriority""")
def agg_pivot_all(spark, d):
    orders = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return agg.pivot_sums(orders, ["o_orderpriority"], "o_orderstatus", ["F", "O"])


@query("agg_filtered", sql="""
    SELECT sum(l_quantity) AS returned_qty, count(*) AS returned_lines FROM lineitem WHERE l_returnflag = 'R'""")
def agg_filtered(spark, d):
    return Tables(spark, d).lineitem.filter(F.col("l_returnflag") == "R").agg(
        F.sum("l_quantity").alias("returned_qty"), F.count("*").alias("returned_lines"))


@query("agg_revenue", sql="""
    SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem GROUP BY l_orderkey""")
def agg_revenue(spark, d):
    return (Tables(spark, d).lineitem.withColumn("amount", net_revenue())
            .groupBy("l_orderkey").agg(F.round(F.sum("amount"), 4).alias("revenue")))


@query("agg_having", sql="""
    SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) > 15""")
def agg_having(spark, d):
    return (Tables(spark, d).orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
            .where(F.col("n_orders") > 15))


@query("agg_having_filter", sql="""
    SELECT o_custkey, count(*) AS n_finished FROM orders WHERE o_orderstatus = 'F'
    GROUP BY o_custkey HAVING count(*) >= 5""")
def agg_having_filter(spark, d):
    return (Tables(spark, d).orders.where("o_orderstatus = 'F'").groupBy("o_custkey")
            .agg(F.count("*").alias("n_finished")).where(F.col("n_finished") >= 5))


@query("agg_by_year", sql="""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1""")
def agg_by_year(spark, d):
    return (_orders_by_year(spark, d).groupBy("year").agg(F.count("*").alias("n"))
            .orderBy(F.col("n").desc(), "year"))


@query("agg_best_month", sql="""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue
    FROM orders GROUP BY 1 ORDER BY revenue DESC, month LIMIT 1""")
def agg_best_month(spark, d):
    m = (Tables(spark, d).orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
         .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue")))
    return m.orderBy(F.col("revenue").desc(), "month").limit(1)


@query("agg_units_city", sql="""
    SELECT n.n_name, sum(l.l_quantity) AS units
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY n.n_name""")
def agg_units_city(spark, d):
    t = Tables(spark, d)
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
    per_cust = (t.orders.select("o_orderkey", "o_custkey")
                .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
                .groupBy("o_custkey").agg(F.sum("q").alias("q")))
    return (per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("q").alias("units")))


@query("agg_distinct_filtered", sql="""
    SELECT count(DISTINCT p_name) AS n_names,
           count(*) FILTER (WHERE p_brand = 'Brand#1') AS brand1_parts FROM part""")
def agg_distinct_filtered(spark, d):
    return Tables(spark, d).part.agg(F.count_distinct("p_name").alias("n_names"),
                                     F.count_if(F.col("p_brand") == "Brand#1").alias("brand1_parts"))
