"""SQL surface (SQL, JN-05, JN-11): the same questions as SQL strings over temp views.

Each query registers the tables it reads as temp views and runs ``spark.sql``; Catalyst
produces the same plans as for the DataFrame forms.
"""

from corvid.plans.registry import query
from corvid.sources.tables import load


def run_sql(spark, d, tables: list[str], text: str):
    for t in tables:
        load(spark, d, t).createOrReplaceTempView(t)
    return spark.sql(text)


def _both(name: str, tables: list[str], text: str, oracle: str | None = None):
    query(name, sql=oracle or text)(lambda spark, d: run_sql(spark, d, tables, text))


_both("sql_where", ["orders"], "SELECT * FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'O'")
_both("sql_limit", ["orders"],
      "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
_both("sql_computed", ["lineitem"],
      "SELECT *, l_quantity * l_extendedprice AS amount, l_quantity * l_extendedprice > 1000000 AS big FROM lineitem")
_both("sql_distinct", ["customer"], "SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1")
_both("sql_count_distinct", ["lineitem"],
      "SELECT COUNT(DISTINCT l_partkey) AS n_parts, COUNT(DISTINCT l_suppkey) AS n_supps FROM lineitem")
_both("sql_agg", ["orders"], """
    SELECT min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, round(avg(o_totalprice), 4) AS avg_price,
           count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'""")
_both("sql_group", ["lineitem"], """
    SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
    FROM lineitem GROUP BY l_suppkey ORDER BY revenue DESC""")
_both("sql_join3", ["customer", "orders", "nation"], """
    SELECT c.c_custkey, o.o_orderkey, n.n_name FROM customer c, orders o, nation n
    WHERE c.c_custkey = o.o_custkey AND c.c_nationkey = n.n_nationkey""")
_both("sql_full3", ["customer", "supplier", "nation"], """
    SELECT coalesce(a.nationkey, b.nationkey, c.nationkey) AS nationkey, a.n_cust, b.n_supp, c.n_name
    FROM (SELECT c_nationkey AS nationkey, count(*) AS n_cust FROM customer GROUP BY 1) a
    FULL OUTER JOIN (SELECT s_nationkey AS nationkey, count(*) AS n_supp FROM supplier GROUP BY 1) b ON a.nationkey = b.nationkey
    FULL OUTER JOIN (SELECT n_nationkey AS nationkey, n_name FROM nation) c
      ON coalesce(a.nationkey, b.nationkey) = c.nationkey""")
_both("sql_range_join", ["orders", "customer"], """
    SELECT o.o_orderkey, o.o_totalprice, c.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_totalprice BETWEEN 100000 AND 110000 ORDER BY o.o_totalprice, o.o_orderkey""")
_both("sql_grouping_sets", ["orders"], """
    SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total,
           grouping_id(o_orderstatus, o_orderpriority) AS gid
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), ())""")
