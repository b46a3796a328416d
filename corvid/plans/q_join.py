"""Join queries (JN)."""

from pyspark.sql import functions as F

from corvid.operators import joins
from corvid.plans.registry import query
from corvid.sources.tables import Tables


@query("join_inner", sql="""
    SELECT o.o_orderkey, o.o_custkey, c.c_custkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(spark, d):
    t = Tables(spark, d)
    return joins.equi_join(t.orders.select("o_orderkey", "o_custkey"), t.customer.select("c_custkey", "c_name"),
                           "o_custkey", "c_custkey")


@query("join_using", sql="""
    SELECT c_nationkey AS nationkey, c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_using(spark, d):
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), "c_custkey")
    n = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return joins.join_using(c, n, ["nationkey"])


def _orders_per_customer(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))


def _events_per_user(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n_events"))


@query("join_full", sql="""
    SELECT o.o_custkey, e.user_id, o.n_orders, e.n_events
    FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
    FULL OUTER JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) e ON o.o_custkey = e.user_id""")
def join_full(spark, d):
    t = Tables(spark, d)
    return joins.equi_join(_orders_per_customer(t), _events_per_user(t), "o_custkey", "user_id", "full_outer", unique=True)


@query("join_full3", sql="""
    SELECT coalesce(a.k, b.k, c.k) AS k, a.n_orders, b.n_events, c.n_cust
    FROM (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1) a
    FULL OUTER JOIN (SELECT user_id AS k, count(*) AS n_events FROM events GROUP BY 1) b ON a.k = b.k
    FULL OUTER JOIN (SELECT c_custkey AS k, count(*) AS n_cust FROM customer GROUP BY 1) c ON coalesce(a.k, b.k) = c.k""")
def join_full3(spark, d):
    t = Tables(spark, d)
    a = _orders_per_customer(t).withColumnRenamed("o_custkey", "k")
    b = _events_per_user(t).withColumnRenamed("user_id", "k")
    c = t.customer.groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("n_cust"))
    return joins.full_outer_chain([a, b, c], "k", unique=True)


def _customers(t):
    return t.customer.select("c_custkey", "c_name")


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey")


_CUSTOMERS, _ORDERS = "(SELECT c_custkey, c_name FROM customer)", "(SELECT o_orderkey, o_custkey FROM orders)"


@query("join_left", sql=f"""
    SELECT c.c_custkey, c.c_name, o.o_orderkey FROM {_CUSTOMERS} c LEFT JOIN {_ORDERS} o ON c.c_custkey = o.o_custkey""")
def join_left(spark, d):
    t = Tables(spark, d)
    return joins.equi_join(_customers(t), _orders(t), "c_custkey", "o_custkey", "left") \
        .select("c_custkey", "c_name", "o_orderkey")


@query("join_right", sql=f"""
    SELECT c.c_custkey, c.c_name, o.o_orderkey FROM {_CUSTOMERS} c RIGHT JOIN {_ORDERS} o ON c.c_custkey = o.o_custkey""")
def join_right(spark, d):
    t = Tables(spark, d)
    return joins.equi_join(_customers(t), _orders(t), "c_custkey", "o_custkey", "right") \
        .select("c_custkey", "c_name", "o_orderkey")


@query("join_semi", sql=f"""
    SELECT c_custkey, c_name FROM {_CUSTOMERS} c WHERE EXISTS (SELECT 1 FROM {_ORDERS} o WHERE o.o_custkey = c.c_custkey)""")
def join_semi(spark, d):
    t = Tables(spark, d)
    return joins.semi(_customers(t), _orders(t), "c_custkey", "o_custkey")


@query("join_anti", sql=f"""
    SELECT c_custkey, c_name FROM {_CUSTOMERS} c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def join_anti(spark, d):
    t = Tables(spark, d)
    return joins.anti(_customers(t), t.events.select("user_id"), "c_custkey", "user_id")


_KV_A = "(SELECT c_custkey AS k, c_name AS a FROM customer)"
_KV_B = "(SELECT o_custkey AS k, o_orderkey AS b FROM orders)"


def _kv_pairs(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("a"))
    b = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("b"))
    return a, b


for _how, _sqlhow in [("inner", "JOIN"), ("full", "FULL OUTER JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN")]:
    def _make(how=_how):
        def fn(spark, d):
            a, b = _kv_pairs(Tables(spark, d))
            if how == "full":
                return joins.full_outer_using(a, b, ["k"]).select("k", "a", "b")
            return joins.join_using(a, b, ["k"], how).select("k", "a", "b")
        return fn
    query(f"kv_join_{_how}", sql=f"""
        SELECT {'coalesce(x.k, y.k)' if _how == 'full' else ('y.k' if _how == 'right' else 'x.k')} AS k, x.a, y.b
        FROM {_KV_A} x {_sqlhow} {_KV_B} y ON x.k = y.k""")(_make())


@query("kv_join3", sql="""
    SELECT c.c_custkey AS k, c.c_name, o.n_orders, n.n_name
    FROM customer c
    JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def kv_join3(spark, d):
    t = Tables(spark, d)
    names = t.customer.select(F.col("c_custkey").alias("k"), "c_name", "c_nationkey")
    counts = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return names.join(counts, "k").join(nations, "c_nationkey").select("k", "c_name", "n_orders", "n_name")


@query("kv_cogroup", sql="""
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.left_n, 0) AS left_n, a.left_sum,
           coalesce(b.right_n, 0) AS right_n, b.right_sum
    FROM (SELECT o_custkey AS k, count(*) AS left_n, CAST(sum(o_orderkey) AS BIGINT) AS left_sum FROM orders GROUP BY o_custkey) a
    FULL OUTER JOIN (SELECT user_id AS k, count(*) AS right_n, CAST(sum(event_id) AS BIGINT) AS right_sum FROM events
          GROUP BY user_id) b ON a.k IS NOT DISTINCT FROM b.k""")
def kv_cogroup(spark, d):
    t = Tables(spark, d)
    events = t.events.select(F.col("user_id").alias("o_custkey"), "event_id")
    return joins.cogroup_stats(t.orders, events, "o_custkey", "o_orderkey", "event_id")


def _chunked_sql(table: str, key: str, value: str, side: str, items: int) -> str:
    return f"""
      SELECT k, chunk, count(*) AS {side}_n, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS {side}_values FROM (
        SELECT {key} AS k, {value} AS v,
               (row_number() OVER (PARTITION BY {key} ORDER BY {value} NULLS FIRST) - 1) // {items} AS chunk FROM {table})
      GROUP BY k, chunk"""


@query("kv_cogroup_lists", sql=f"""
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.chunk, b.chunk) AS chunk, coalesce(left_n, 0) AS left_n,
           coalesce(left_values, '') AS left_values, coalesce(right_n, 0) AS right_n,
           coalesce(right_values, '') AS right_values
    FROM ({_chunked_sql("orders", "o_custkey", "o_orderkey", "left", 20)}) a
    FULL OUTER JOIN ({_chunked_sql("events", "user_id", "event_id", "right", 20)}) b
      ON a.k IS NOT DISTINCT FROM b.k AND a.chunk = b.chunk""")
def kv_cogroup_lists(spark, d):
    """Every customer's orders beside their events, both as lists of at most 20."""
    t = Tables(spark, d)
    both = joins.cogroup_lists(t.orders, t.events, "o_custkey", "o_orderkey", "event_id", right_key="user_id", max_items=20)
    return both.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("left_values", "right_values")})


@query("kv_zip", sql="""
    SELECT s.idx, s.s_suppkey, p.p_partkey FROM
      (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS idx, s_suppkey FROM supplier) s
    JOIN (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, p_partkey FROM part) p ON s.idx = p.idx""")
def kv_zip(spark, d):
    t = Tables(spark, d)
    return joins.zip_by_position(t.supplier.select("s_suppkey"), t.part.select("p_partkey"),
                                 ["s_suppkey"], ["p_partkey"]).select("idx", "s_suppkey", "p_partkey")


@query("job_station_counts", sql="""
    SELECT s.s_suppkey, s.s_name, a.n_returned, b.n_open
    FROM supplier s
    LEFT JOIN (SELECT l_suppkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a
      ON s.s_suppkey = a.l_suppkey
    LEFT JOIN (SELECT l_suppkey, count(*) AS n_open FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 45
               GROUP BY 1) b ON s.s_suppkey = b.l_suppkey""")
def job_station_counts(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    out = joins.dimension_with_counts(
        t.supplier.select("s_suppkey", "s_name"), "s_suppkey",
        {"n_returned": (li.where("l_returnflag = 'R'"), "l_suppkey"),
         "n_open": (li.where("l_linestatus = 'O' AND l_quantity > 45"), "l_suppkey")})
    return out.select("s_suppkey", "s_name", "n_returned", "n_open")


@query("join_nodup", sql="""
    SELECT DISTINCT c_custkey, c_name, o_orderstatus FROM customer JOIN orders ON c_custkey = o_custkey""")
def join_nodup(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", "c_name")
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return joins.join_no_duplicates(c, o, ["c_custkey"])


@query("job_avg_by_dim", sql="""
    SELECT p.p_brand, round(avg(l.l_extendedprice), 6) AS avg_price, count(*) AS n
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_brand""")
def job_avg_by_dim(spark, d):
    t = Tables(spark, d)
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("s"), F.count("*").alias("n"))
    j = per_part.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("p_brand").agg(F.round(F.sum("s") / F.sum("n"), 6).alias("avg_price"),
                                    F.sum("n").alias("n"))
