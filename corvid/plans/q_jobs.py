"""Multi-step jobs composed from the operator families (sales clean-up)."""

from pyspark.sql import functions as F

from corvid.operators import jobs
from corvid.plans.registry import query
from corvid.session import scratch_path
from corvid.sources import files
from corvid.sources.tables import Tables

_CLEAN = """
    SELECT l.l_quantity AS qty, l.l_extendedprice / l.l_quantity AS price, o.o_orderdate AS ts, n.n_name AS city
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_orderstatus <> 'P'"""


def _clean_sales(spark, d):
    t = Tables(spark, d)
    raw = jobs.sales_lines(t.lineitem, t.orders, t.customer, t.nation, t.region)
    # CSV parts as the join deals them, each with its own header; read back as plain text rows
    path = files.write_csv(raw, scratch_path(spark, "sales"), header=True)
    text_rows = files.read_csv(spark, path, header=False, names=jobs.SALES_COLUMNS)
    return jobs.clean_sales(text_rows)


@query("job_sales_best_month", sql=f"""
    SELECT CAST(year(ts) AS INTEGER) AS Year, CAST(month(ts) AS INTEGER) AS Month,
           round(sum(qty * price), 2) AS revenue
    FROM ({_CLEAN}) GROUP BY 1, 2 ORDER BY revenue DESC, Year, Month LIMIT 1""")
def job_sales_best_month(spark, d):
    s = _clean_sales(spark, d)
    m = s.groupBy("Year", "Month").agg(F.round(F.sum(F.col("QuantityOrdered") * F.col("PriceEach")), 2).alias("revenue"))
    return m.orderBy(F.col("revenue").desc(), "Year", "Month").limit(1)


@query("job_sales_units_city", sql=f"SELECT city AS City, CAST(sum(qty) AS BIGINT) AS units FROM ({_CLEAN}) GROUP BY 1")
def job_sales_units_city(spark, d):
    s = _clean_sales(spark, d)
    return s.groupBy("City").agg(F.sum("QuantityOrdered").alias("units"))
