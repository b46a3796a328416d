"""Sort, limit, top-k (ORD) and set operations (SET)."""

from pyspark.sql import functions as F

from corvid.operators import ordering
from corvid.plans.registry import query
from corvid.sources.tables import Tables


@query("ord_sort", sql="""
    SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS pos, c_custkey, c_acctbal FROM customer""")
def ord_sort(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_acctbal")
    return ordering.sort_rows(c, ["c_acctbal", "c_custkey"], position="pos")


@query("ord_multi", sql="""
    SELECT row_number() OVER (ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS pos,
           o_orderkey, o_orderpriority, o_totalprice FROM orders""")
def ord_multi(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordering.sort_rows(o, ["o_orderpriority desc", "o_totalprice", "o_orderkey"], position="pos")


@query("ord_limit", sql="""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def ord_limit(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return ordering.top_k(o, 5, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("ord_by_key", sql="""
    SELECT row_number() OVER (ORDER BY l_suppkey DESC) AS pos, l_suppkey AS k, count(*) AS n
    FROM lineitem GROUP BY l_suppkey""")
def ord_by_key(spark, d):
    pairs = Tables(spark, d).lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n"))
    return ordering.sort_rows(pairs, ["k desc"], position="pos")


@query("ord_by_expr", sql="""
    SELECT row_number() OVER (ORDER BY length(p_name), p_name, p_partkey) AS pos, p_partkey, p_name FROM part""")
def ord_by_expr(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name").withColumn("_len", F.length("p_name"))
    return ordering.sort_rows(p, ["_len", "p_name", "p_partkey"], position="pos").drop("_len")


@query("ord_topk", sql="""
    SELECT p_partkey, p_name, p_retailprice * p_size AS score FROM part
    ORDER BY p_retailprice * p_size DESC, p_partkey LIMIT 3""")
def ord_topk(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", (F.col("p_retailprice") * F.col("p_size")).alias("score"))
    return ordering.top_k(p, 3, [F.col("score").desc(), "p_partkey"])


@query("ord_agg_topn", sql="""
    SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey ORDER BY qty DESC, l_partkey LIMIT 10""")
def ord_agg_topn(spark, d):
    a = Tables(spark, d).lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return ordering.top_k(a, 10, [F.col("qty").desc(), "l_partkey"])


@query("set_union_all", sql="""
    SELECT c_nationkey AS nationkey, 'customer' AS src FROM customer
    UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def set_union_all(spark, d):
    t = Tables(spark, d)
    return ordering.union_all(
        t.customer.select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("src")),
        t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("src")))


@query("set_union_reduce", sql="""
    SELECT nationkey, round(sum(bal), 2) AS total_bal FROM (
      SELECT c_nationkey AS nationkey, c_acctbal AS bal FROM customer
      UNION ALL SELECT s_nationkey, s_acctbal FROM supplier) GROUP BY nationkey""")
def set_union_reduce(spark, d):
    t = Tables(spark, d)
    u = ordering.union_all(t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("bal")),
                           t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("bal")))
    return u.groupBy("nationkey").agg(F.round(F.sum("bal"), 2).alias("total_bal"))


@query("set_union3", sql="SELECT o_orderkey, o_orderstatus FROM orders")
def set_union3(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    done, open_ = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    rest = ~F.coalesce(done | open_, F.lit(False))  # any other status, or none
    return ordering.union_all(o.where(done), o.where(open_), o.where(rest))


@query("set_intersect", sql="""
    SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
    INTERSECT SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 2000""")
def set_intersect(spark, d):
    li = Tables(spark, d).lineitem
    return ordering.intersect_keys(li.where("l_returnflag = 'R'"), li.where(F.year("l_shipdate") == 2000), ["l_partkey"])
