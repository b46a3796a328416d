"""The same question answered with the DataFrame API and with Spark SQL must agree, and a
streaming transformation must agree with the same function applied to the batch table."""

from pyspark.sql import functions as F

from corvid.plans.q_sql import run_sql
from corvid.session import scratch_path
from corvid.sources.tables import Tables
from corvid.streaming import run, sources
from corvid.streaming import transforms as st

from testdata import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_group_dataframe_equals_sql(spark):
    li = Tables(spark, SF_SMALL).lineitem
    df_form = li.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    sql_form = run_sql(spark, SF_SMALL, ["lineitem"],
                       "SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey")
    assert _rows(df_form) == _rows(sql_form)


def test_join_dataframe_equals_sql(spark):
    t = Tables(spark, SF_SMALL)
    df_form = (t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
               .where("o_orderstatus = 'F'").select("c_custkey", "o_orderkey"))
    sql_form = run_sql(spark, SF_SMALL, ["customer", "orders"], """
        SELECT c_custkey, o_orderkey FROM customer, orders WHERE c_custkey = o_custkey AND o_orderstatus = 'F'""")
    assert _rows(df_form) == _rows(sql_form)


def test_stream_equals_batch_on_closed_windows(spark):
    e = Tables(spark, SF_SMALL).events
    path = sources.replay_files(e, scratch_path(spark, "eq"), "ts", 3)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    s = st.event_time(sources.file_stream(spark, path, "parquet", schema, max_files_per_trigger=1), "ts")
    streamed = run.run_to_table(spark, st.windowed_counts(s, "ts", "1 hour", ["event_type"], watermark="1 hour"),
                                "append", "eq-out")
    batch = st.windowed_counts(st.event_time(e, "ts"), "ts", "1 hour", ["event_type"])
    wm = st.event_time(e, "ts").agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = batch.where(F.col("window.end") <= F.lit(wm - dt.timedelta(hours=1)))
    assert _rows(streamed.select("window", "event_type", "n")) == _rows(closed.select("window", "event_type", "n"))
