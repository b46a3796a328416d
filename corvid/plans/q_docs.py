"""Document-collection queries (DOC) on the nested orders table and on JSON payloads
derived from the tables."""

from pyspark.sql import functions as F

from corvid.operators import agg, docs
from corvid.plans.registry import query
from corvid.session import scratch_path
from corvid.sources.documents import nested_orders, order_headers
from corvid.sources.tables import Tables
from corvid.streaming import sources
from corvid.streaming import weather as sink
from corvid.streaming.sessions import stream_session


def _docs(spark, d):
    t = Tables(spark, d)
    return nested_orders(t.orders, t.lineitem)


def _headers(spark, d):
    return order_headers(Tables(spark, d).orders)


@query("doc_find_one", sql="""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 1""")
def doc_find_one(spark, d):
    return docs.find_one(_headers(spark, d), F.col("o_orderstatus") == "P", ["o_orderkey"]) \
        .select("o_orderkey", "o_custkey", "o_totalprice")


@query("doc_recent", sql="""
    SELECT o_custkey, o_totalprice, o_orderdate FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""")
def doc_recent(spark, d):
    pred = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    res = docs.find(_headers(spark, d), pred, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 10,
                    hidden=["o_orderkey"])
    return res.select("o_custkey", "o_totalprice", "o_orderdate")


@query("doc_group_count", sql="""
    SELECT o_totalprice > 250000 AS key, count(*) AS n FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1""")
def doc_group_count(spark, d):
    return docs.count_by(_headers(spark, d), F.col("o_totalprice") > 250000)


@query("doc_unwind_sum", sql="""
    SELECT o.o_orderpriority, sum(l.l_quantity) AS total
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag = 'R'
    GROUP BY o.o_orderpriority""")
def doc_unwind_sum(spark, d):
    return docs.unwind_match_sum(_docs(spark, d), "items", F.col("item.l_returnflag") == "R",
                                 "o_orderpriority", "l_quantity")


@query("doc_limit", sql="SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def doc_limit(spark, d):
    return _headers(spark, d).select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(20)


@query("doc_stations", sql="""
    SELECT n.n_name AS city, s.s_name AS name, CAST(s.s_suppkey % 7 AS INTEGER) AS free_bikes,
           CASE WHEN s.s_acctbal < 0 THEN 0 ELSE CAST(s.s_suppkey % 5 AS INTEGER) END AS empty_slots
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def doc_stations(spark, d):
    """Network payloads built from suppliers grouped per nation (in bounded blocks), with
    ``empty_slots`` omitted for some stations, then flattened back."""
    t = Tables(spark, d)
    stations = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .select("n_name", F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
                                           (F.col("s_suppkey") % 7).cast("int").alias("free_bikes"),
                                           F.when(F.col("s_acctbal") >= 0, (F.col("s_suppkey") % 5).cast("int"))
                                           .alias("empty_slots")).alias("st")))
    blocks = agg.collect_bounded(stations, ["n_name"], F.col("st"), max_items=500, out="stations")
    payload = blocks.select(F.to_json(F.struct(F.struct(
        F.col("n_name").alias("id"), F.struct(F.col("n_name").alias("city"), F.lit("XX").alias("country"))
        .alias("location"), F.col("stations").alias("stations")).alias("network"))).alias("json"))
    return docs.flatten_stations(payload)


def _weather_payload(e):
    """Payloads of city, value and time; half of them carry `timestamp`, the others `local_timestamp`."""
    ts_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return e.select("event_id", "event_type", "ts", F.to_json(F.struct(
        F.col("value").alias("temperature"),
        F.when(F.col("event_id") % 2 == 0, ts_text).alias("local_timestamp"),
        F.when(F.col("event_id") % 2 == 1, ts_text).alias("timestamp"))).alias("json"))


@query("doc_weather", sql="""
    SELECT event_id, event_type AS city, value AS temperature, date_trunc('second', ts) AS event_time FROM events""")
def doc_weather(spark, d):
    w = docs.enrich_weather(_weather_payload(Tables(spark, d).events), city=F.col("event_type"))
    return w.select("event_id", "city", "temperature", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query("doc_weather_slice", sql="""
    SELECT hour, round(avg(value), 6) AS avg_value, count(*) AS n FROM
      (SELECT date_trunc('hour', ts) AS hour, value FROM events
       WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12')
    GROUP BY hour ORDER BY hour""")
def doc_weather_slice(spark, d):
    """One city and a week of what a stream of payloads has committed to its sink so far."""
    base = scratch_path(spark, "weather")
    events = Tables(spark, d).events
    path, each = sources.replay_batches(_weather_payload(events), f"{base}/in", "ts", 4, inputs=[events])
    raw = sources.file_stream(stream_session(spark), path, "parquet",
                              "event_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ, json STRING", max_files_per_trigger=each)
    sink.run_weather_sink(spark, docs.enrich_weather(raw, city=F.col("event_type")), f"{base}/out", f"{base}/_checkpoint")
    part = sink.weather_slice(spark, f"{base}/out", "click", "2024-01-05", "2024-01-12")
    hourly = (part.groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour"))
              .agg(F.round(F.avg("temperature"), 6).alias("avg_value"), F.count("*").alias("n")))
    return hourly.orderBy("hour")
