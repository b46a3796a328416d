"""Flagship query: top customers by net revenue (load, project, join, aggregate, top-k)."""

from corvid.operators.jobs import top_customers_by_revenue
from corvid.plans.registry import query
from corvid.sources.tables import Tables


@query("job_top_customers", sql="""
    WITH rev AS (
      SELECT o.o_custkey AS c_custkey,
             round(sum(l.l_extendedprice * (1 - l.l_discount)), 4) AS revenue,
             count(DISTINCT o.o_orderkey) AS n_orders
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      GROUP BY o.o_custkey),
    best AS (SELECT * FROM rev ORDER BY revenue DESC, c_custkey LIMIT 10)
    SELECT b.c_custkey, c.c_name, n.n_name, b.revenue, b.n_orders
    FROM best b LEFT JOIN customer c ON c.c_custkey = b.c_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def job_top_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return top_customers_by_revenue(t.lineitem, t.orders, t.customer, t.nation, k=10)
