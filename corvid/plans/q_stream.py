"""Structured Streaming queries (STR).

Each query replays a table as time-ordered files, runs the streaming plan to completion
with an available-now trigger into a sink on shared scratch storage, and returns the sink
as a batch DataFrame. Oracles for append mode keep only the windows the final watermark
(max event time - delay) has closed: ``window_end <= max(ts) - delay``.
"""

from pyspark.sql import functions as F

from corvid.operators import windows
from corvid.plans.registry import query
from corvid.session import scratch_path
from corvid.sources.documents import nested_orders, order_headers
from corvid.sources.tables import Tables
from corvid.streaming import progress, rows, run, sinks, sources, spans
from corvid.streaming import transforms as st
from corvid.streaming.sessions import stream_session

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDER_SCHEMA = ("o_orderkey BIGINT, block BIGINT, o_custkey BIGINT, nation STRING, o_totalprice DOUBLE, "
                "lines ARRAY<STRUCT<l_partkey: BIGINT, l_quantity: DOUBLE, l_extendedprice: DOUBLE, charged: DOUBLE>>")
HEADER_SCHEMA = "o_orderkey BIGINT, block BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"
WM = "(SELECT max(ts) FROM events)"


def _events_stream(spark, d, name, n_files=4, fmt="parquet", extra=None):
    e = Tables(spark, d).events
    path, each = sources.replay_batches(e, scratch_path(spark, name), "ts", n_files, fmt=fmt, extra=extra)
    s = sources.file_stream(stream_session(spark), path, fmt, EVENTS_SCHEMA, max_files_per_trigger=each)
    return st.event_time(s, "ts")


@query("str_file", sql="SELECT event_id, event_type, value FROM events")
def str_file(spark, d):
    s = _events_stream(spark, d, "str-file", fmt="json")
    return run.run_to_table(spark, s.select("event_id", "event_type", "value"), "append", "str-file-out")


@query("str_file_csv", sql="SELECT event_id, event_type, value FROM events")
def str_file_csv(spark, d):
    s = _events_stream(spark, d, "str-file-csv", fmt="csv")
    return run.run_to_table(spark, s.select("event_id", "event_type", "value"), "append", "str-file-csv-out")


@query("str_file_orc", sql="SELECT event_id, event_type, value FROM events")
def str_file_orc(spark, d):
    s = _events_stream(spark, d, "str-file-orc", fmt="orc")
    return run.run_to_table(spark, s.select("event_id", "event_type", "value"), "append", "str-file-orc-out")


@query("str_file_text", sql="SELECT event_id, event_type FROM events")
def str_file_text(spark, d):
    lines = Tables(spark, d).events.select("ts", F.concat_ws(" ", "event_id", "event_type").alias("value"))
    path, each = sources.replay_batches(lines, scratch_path(spark, "str-file-text"), "ts", 4, fmt="text", columns=["value"])
    s = sources.file_stream(stream_session(spark), path, "text", "value STRING", max_files_per_trigger=each)
    fields = F.split("value", " ", 2)
    out = s.select(F.get(fields, 0).try_cast("bigint").alias("event_id"), F.get(fields, 1).alias("event_type"))
    return run.run_to_table(spark, out, "append", "str-file-text-out")


@query("str_filter", sql="SELECT event_id, user_id, value FROM events WHERE event_type = 'error' AND value > 10")
def str_filter(spark, d):
    s = _events_stream(spark, d, "str-filter")
    out = s.select("event_id", "user_id", "value", "event_type").where("event_type = 'error' AND value > 10")
    return run.run_to_table(spark, out.drop("event_type"), "append", "str-filter-out")


@query("str_count", sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def str_count(spark, d):
    s = _events_stream(spark, d, "str-count")
    return run.run_to_table(spark, s.groupBy("event_type").agg(F.count("*").alias("n")), "complete", "str-count-out")


@query("str_wordcount", sql=r"""
    SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word
    FROM conversations) WHERE word <> '' GROUP BY word""")
def str_wordcount(spark, d):
    """Counts of an open vocabulary in update mode: a batch changes the rows of its own words."""
    c = Tables(spark, d).conversations.select(F.col("conv_id").alias("ord"), F.col("text").alias("value"))
    path, each = sources.replay_batches(c, scratch_path(spark, "str-wc"), "ord", 3, fmt="parquet")
    lines = sources.file_stream(stream_session(spark), path, "parquet", "ord BIGINT, value STRING", max_files_per_trigger=each)
    return run.run_to_table(spark, st.word_counts(lines, "value"), "update", "str-wc-out", keys=["word"])


@query("str_tumbling", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                          time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 1 HOUR""")
def str_tumbling(spark, d):
    s = _events_stream(spark, d, "str-tumbling")
    agg = st.windowed_counts(s, "ts", "1 hour", ["event_type"], watermark="1 hour")
    return st.window_bounds(run.run_to_table(spark, agg, "append", "str-tumbling-out"))


@query("str_sliding", sql=f"""
    SELECT * FROM (
      SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS n FROM (
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type FROM events
        UNION ALL SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR, event_type FROM events)
      GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 1 HOUR""")
def str_sliding(spark, d):
    s = _events_stream(spark, d, "str-sliding")
    agg = st.windowed_counts(s, "ts", "2 hours", ["event_type"], slide="1 hour", watermark="1 hour")
    return st.window_bounds(run.run_to_table(spark, agg, "append", "str-sliding-out"))


@query("str_session", sql=f"""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR
                                        THEN 0 ELSE 1 END AS new_session FROM events),
    s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
    FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL 6 HOUR <= {WM} - INTERVAL 1 HOUR""")
def str_session(spark, d):
    s = _events_stream(spark, d, "str-session")
    agg = st.session_counts(s, "ts", "6 hours", ["user_id"], watermark="1 hour")
    out = run.run_to_table(spark, agg, "append", "str-session-out")
    return out.select("user_id", F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session.end").cast("timestamp_ntz").alias("session_end"), "n")


@query("str_buy_sell", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                          time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                          round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS buys,
                          round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END), 2) AS sells
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 30 MINUTE""")
def str_buy_sell(spark, d):
    s = _events_stream(spark, d, "str-buysell")
    agg = st.buy_sell_windows(s, "ts", "1 day", "event_type", "value", "purchase", "click", watermark="30 minutes")
    out = st.window_bounds(run.run_to_table(spark, agg, "append", "str-buysell-out"))
    return out.select("window_start", "window_end", F.round("buys", 2).alias("buys"), F.round("sells", 2).alias("sells"))


@query("str_watermark_append", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                          time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
                          strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d') AS day
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 30 MINUTE""")
def str_watermark_append(spark, d):
    """Watermark + append into a date-partitioned Parquet sink."""
    s = _events_stream(spark, d, "str-wm")
    agg = st.windowed_counts(s, "ts", "1 hour", ["event_type"], watermark="30 minutes")
    agg = agg.withColumn("day", F.to_date(F.col("window.start")))
    out = run.run_to_table(spark, agg, "append", "str-wm-out", partition_by=["day"])
    return st.window_bounds(out).select("window_start", "window_end", "event_type", "n",
                                        F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("str_late", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                          time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 2 HOUR""")
def str_late(spark, d):
    """The first day's events are replayed once more after all others: far behind the
    watermark, so they are dropped and every count equals the on-time count."""
    e = Tables(spark, d).events
    lo = e.agg(F.min("ts")).first()[0]
    late = e.where(F.col("ts") < F.lit(lo) + F.expr("INTERVAL 1 DAY"))
    s = _events_stream(spark, d, "str-late", extra=[late])
    agg = st.windowed_counts(s, "ts", "1 hour", [], watermark="2 hours")
    return st.window_bounds(run.run_to_table(spark, agg, "append", "str-late-out"))


@query("str_window_avg", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
                          time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type,
                          round(avg(value), 6) AS avg_value,
                          round(avg(CAST(json_extract(props, '$.k') AS INTEGER)), 6) AS avg_k
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 1 HOUR""")
def str_window_avg(spark, d):
    s = _events_stream(spark, d, "str-avg")
    s = s.withColumn("k", F.from_json("props", "k INT").getField("k"))
    agg = st.window_averages(s, "ts", "6 hours", "event_type", {"avg_value": F.col("value"), "avg_k": F.col("k")},
                             watermark="1 hour")
    out = st.window_bounds(run.run_to_table(spark, agg, "append", "str-avg-out"))
    return out.select("window_start", "window_end", "event_type", F.round("avg_value", 6).alias("avg_value"),
                      F.round("avg_k", 6).alias("avg_k"))


@query("str_window_sum", sql="""
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
           event_type, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def str_window_sum(spark, d):
    """Update mode: every batch emits the windows it changed; the table keeps the newest row per
    (window, key)."""
    s = _events_stream(spark, d, "str-sum")
    agg = (s.withWatermark("ts", "1 day").groupBy(F.window("ts", "1 day").alias("window"), "event_type")
           .agg(F.sum("value").alias("total")))
    latest = run.run_to_table(spark, agg, "update", "str-sum-out", keys=["window", "event_type"])
    return st.window_bounds(latest).select("window_start", "window_end", "event_type",
                                           F.round("total", 2).alias("total"))


@query("str_avg_of_avg", sql=f"""
    WITH u AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, user_id, avg(value) AS ua
               FROM events GROUP BY ALL)
    SELECT * FROM (SELECT window_start, window_start + INTERVAL 1 DAY AS window_end,
                          round(avg(ua), 6) AS avg_of_avg, count(*) AS n_entities FROM u GROUP BY window_start)
    WHERE window_end <= {WM} - INTERVAL 1 HOUR""")
def str_avg_of_avg(spark, d):
    s = _events_stream(spark, d, "str-avgavg")
    agg = st.avg_of_averages(s, "ts", "1 day", "user_id", "value", watermark="1 hour")
    out = st.window_bounds(run.run_to_table(spark, agg, "append", "str-avgavg-out"))
    return out.select("window_start", "window_end", F.round("avg_of_avg", 6).alias("avg_of_avg"), "n_entities")


@query("str_join_windows", sql=f"""
    WITH a AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS clicks FROM events
               WHERE event_type = 'click' GROUP BY 1),
    b AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, round(sum(value), 2) AS purchases FROM events
          WHERE event_type = 'purchase' GROUP BY 1)
    SELECT a.window_start, a.window_start + INTERVAL 1 DAY AS window_end, clicks, purchases
    FROM a JOIN b ON a.window_start = b.window_start
    WHERE a.window_start + INTERVAL 1 DAY <= {WM} - INTERVAL 1 HOUR""")
def str_join_windows(spark, d):
    e = Tables(spark, d).events
    path, each = sources.replay_batches(e, scratch_path(spark, "str-join"), "ts", 4)
    own = stream_session(spark)

    def side(kind):
        s = st.event_time(sources.file_stream(own, path, "parquet", EVENTS_SCHEMA, max_files_per_trigger=each), "ts")
        return s.where(F.col("event_type") == kind).withWatermark("ts", "1 hour")

    clicks = side("click").groupBy(F.window("ts", "1 day").alias("window")).agg(F.count("*").alias("clicks"))
    buys = side("purchase").groupBy(F.window("ts", "1 day").alias("window")).agg(F.sum("value").alias("purchases"))
    out = st.window_bounds(run.run_to_table(spark, st.join_on_window(clicks, buys), "append", "str-join-out"))
    return out.select("window_start", "window_end", "clicks", F.round("purchases", 2).alias("purchases"))


def _records(orders, name, spark, inputs):
    """A stream of key/value records of ``orders`` (JSON), which are made of ``inputs``, in order of date."""
    value = F.to_json(F.struct(*[c for c in orders.columns if c != "o_orderdate"]))
    records = orders.select(F.col("o_orderkey").cast("string").cast("binary").alias("key"),
                            value.cast("binary").alias("value"), F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    path, each = sources.replay_batches(records, scratch_path(spark, name), "timestamp", 3, inputs=inputs)
    return sources.file_stream(stream_session(spark), path, "parquet", "key BINARY, value BINARY, timestamp TIMESTAMP",
                               max_files_per_trigger=each)


def _order_records(spark, d, name):
    """Records of whole orders with their lines, in blocks."""
    t = Tables(spark, d)
    docs = nested_orders(t.orders, t.lineitem).join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left").join(
        t.nation.select("n_nationkey", F.col("n_name").alias("nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    lines = F.transform("items", lambda i: F.struct(i["l_partkey"], i["l_quantity"], i["l_extendedprice"],
                                                    (i["l_extendedprice"] * (1 - i["l_discount"])).alias("charged")))
    orders = docs.select("o_orderkey", "block", "o_custkey", "nation", "o_totalprice", lines.alias("lines"), "o_orderdate")
    return _records(orders, name, spark, [t.orders, t.lineitem])


def _header_records(spark, d, name):
    """Records of the orders' own fields, for queries that don't look into the lines."""
    headers = order_headers(Tables(spark, d).orders)
    orders = headers.withColumn("block", F.lit(0)).select("o_orderkey", "block", "o_custkey", "o_totalprice", "o_orderdate")
    return _records(orders, name, spark, [headers])


@query("str_invoices", sql="""
    SELECT o.o_orderkey, o.o_custkey, n.n_name AS nation, l.l_partkey, l.l_quantity, l.l_extendedprice,
           l.l_extendedprice * (1 - l.l_discount) AS charged
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def str_invoices(spark, d):
    items = st.order_lines(_order_records(spark, d, "str-inv"), ORDER_SCHEMA)
    return run.run_to_table(spark, items, "append", "str-inv-out")


@query("str_loyalty", sql="""
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_custkey AS customer, o_totalprice AS spent,
           o_totalprice * 0.2 AS points FROM orders""")
def str_loyalty(spark, d):
    rec = st.reward_records(_header_records(spark, d, "str-loyalty"), HEADER_SCHEMA)
    out = run.run_to_table(spark, rec, "append", "str-loyalty-out")
    v = F.from_json("value", "customer BIGINT, spent DOUBLE, points DOUBLE")
    return out.select("key", v.alias("v")).select("key", "v.*")


@query("str_encode", sql=r"""
    SELECT word AS key, CAST(count(*) AS VARCHAR) AS value FROM (
      SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM conversations)
    WHERE word <> '' GROUP BY word""")
def str_encode(spark, d):
    """Word counts as key/value records, the newest per key in an upsert table."""
    c = Tables(spark, d).conversations.select(F.col("conv_id").alias("ord"), F.col("text").alias("value"))
    path, each = sources.replay_batches(c, scratch_path(spark, "str-enc"), "ord", 2)
    lines = sources.file_stream(stream_session(spark), path, "parquet", "ord BIGINT, value STRING", max_files_per_trigger=each)
    enc = sinks.encode_record(st.word_counts(lines, "value"), "word", value="n")
    return run.run_to_table(spark, enc, "update", "str-enc-out", keys=["key"])


@query("str_sink_json", sql=f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                          time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS n
                   FROM events GROUP BY ALL)
    WHERE window_end <= {WM} - INTERVAL 1 HOUR""")
def str_sink_json(spark, d):
    s = _events_stream(spark, d, "str-json")
    agg = st.window_bounds(st.windowed_counts(s, "ts", "1 day", [], watermark="1 hour"), ntz=False)
    base = scratch_path(spark, "str-json-out")
    q = run.start(agg, "append", f"{base}/_checkpoint", fmt="json", path=f"{base}/out")
    run.await_done(q)
    back = spark.read.schema("window_start TIMESTAMP, window_end TIMESTAMP, n BIGINT").json(f"{base}/out")
    return back.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n")


@query("str_foreach_batch", sql="SELECT event_id, value FROM events WHERE value > 50")
def str_foreach_batch(spark, d):
    s = _events_stream(spark, d, "str-feb").where("value > 50").select("event_id", "value")
    base = scratch_path(spark, "str-feb-out")
    q = run.start(s, "append", f"{base}/_checkpoint", foreach_batch=sinks.batch_folders(f"{base}/out"))
    run.await_done(q)
    return spark.read.parquet(f"{base}/out").drop("batch_id")


@query("str_restart", sql="SELECT event_id, event_type FROM events")
def str_restart(spark, d):
    """Two runs on one checkpoint: the second run, after more files arrived, processes only
    the new files; the file sink commits each batch once, so no row is duplicated."""
    e = Tables(spark, d).events
    base = scratch_path(spark, "str-restart")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    # events without a time are in the first half, as all are when no event has one
    late = F.lit(False) if lo is None else F.coalesce(F.col("ts") >= F.lit(lo + (hi - lo) / 2), F.lit(False))
    e.where(~late).write.parquet(f"{base}/in/b000")
    ckpt, out = f"{base}/_checkpoint", f"{base}/out"

    def once():
        s = sources.file_stream(stream_session(spark), f"{base}/in/b*", "parquet", EVENTS_SCHEMA, max_files_per_trigger=1)
        run.await_done(run.start(s.select("event_id", "event_type"), "append", ckpt, fmt="parquet", path=out))

    once()
    e.where(late).write.parquet(f"{base}/in/b001")
    once()
    return spark.read.parquet(out)


@query("str_sorted", sql="""
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
           count(*) AS n FROM events GROUP BY ALL""")
def str_sorted(spark, d):
    s = _events_stream(spark, d, "str-sorted")
    agg = s.groupBy(F.window("ts", "1 day").alias("window")).agg(F.count("*").alias("n")).orderBy("window")
    return st.window_bounds(run.run_to_table(spark, agg, "complete", "str-sorted-out"))


@query("str_then_batch", sql=f"""
    WITH h AS (SELECT * FROM (
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
               sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS buys,
               sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS sells
        FROM events GROUP BY ALL) WHERE window_end <= {WM} - INTERVAL 30 MINUTE)
    SELECT window_start, window_end,
           round(sum(buys) OVER (ORDER BY window_end ROWS UNBOUNDED PRECEDING), 2) AS total_buys,
           round(sum(sells) OVER (ORDER BY window_end ROWS UNBOUNDED PRECEDING), 2) AS total_sells,
           round(sum(buys - sells) OVER (ORDER BY window_end ROWS UNBOUNDED PRECEDING), 2) AS net
    FROM h""")
def str_then_batch(spark, d):
    s = _events_stream(spark, d, "str-net")
    agg = st.buy_sell_windows(s, "ts", "1 hour", "event_type", "value", "purchase", "click", watermark="30 minutes")
    out = st.window_bounds(run.run_to_table(spark, agg, "append", "str-net-out"))
    out = out.withColumn("diff", F.col("buys") - F.col("sells"))
    r = windows.running(out, [], ["window_end"], {"total_buys": ("sum", "buys"), "total_sells": ("sum", "sells"),
                                                  "net": ("sum", "diff")})
    return r.select("window_start", "window_end", *[F.round(c, 2).alias(c) for c in ["total_buys", "total_sells", "net"]])


_SPANS = """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR
                                        THEN 0 ELSE 1 END AS new_span FROM events),
    s AS (SELECT *, sum(new_span) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, sid"""


def _plain_spans(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


@query("str_spans", sql=f"{_SPANS} HAVING max(ts) + INTERVAL 6 HOUR <= {WM} - INTERVAL 1 HOUR")
def str_spans(spark, d):
    """Keyed state with timers, append mode: each user's activity spans once they are over."""
    out = spans.activity_spans(_events_stream(spark, d, "str-spans"), "user_id", "ts", "6 hours", "1 hour", "append")
    return _plain_spans(run.run_to_table(spark, out, "append", "str-spans-out"))


@query("str_spans_update", sql=_SPANS)
def str_spans_update(spark, d):
    """The same in update mode: open spans too, the newest state of each."""
    out = spans.activity_spans(_events_stream(spark, d, "str-spans-u"), "user_id", "ts", "6 hours", "1 hour", "update")
    table = run.run_to_table(spark, out, "update", "str-spans-u-out", keys=["user_id", "first"])
    return _plain_spans(table.where("n > 0"))


@query("str_stateful_count", sql="SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def str_stateful_count(spark, d):
    """Counts per user from keyed state that forgets users who are idle: what has left the state
    is in the table of spans."""
    out = spans.activity_spans(_events_stream(spark, d, "str-state"), "user_id", "ts", "1 hour", "1 hour", "update")
    table = run.run_to_table(spark, out, "update", "str-state-out", keys=["user_id", "first"])
    return table.groupBy("user_id").agg(F.sum("n").alias("n"))


@query("str_foreach", sql="SELECT event_id, event_type, value FROM events")
def str_foreach(spark, d):
    """Single rows through open, process and close, committed per partition and epoch."""
    s = _events_stream(spark, d, "str-foreach").select("event_id", "event_type", "value")
    base = scratch_path(spark, "str-foreach-out")
    writer = rows.RowFiles(f"{base}/out", s.schema)
    run.await_done(run.start(s, "append", f"{base}/_checkpoint", foreach=writer))
    return rows.read_rows(spark, f"{base}/out", s.schema)


@query("str_progress", sql="""
    SELECT 'progress' AS name, count(*) AS input_rows, CAST(4 AS BIGINT) AS batches, CAST(0 AS BIGINT) AS first_batch,
           CAST(3 AS BIGINT) AS last_batch FROM events""")
def str_progress(spark, d):
    """Progress rows that a listener stored while four files were read, one per batch."""
    s = _events_stream(spark, d, "str-progress", n_files=4).select("event_id")
    base = scratch_path(spark, "str-progress-out")
    with progress.logged(s.sparkSession, f"{base}/progress") as log:
        q = run.start(s, "append", f"{base}/_checkpoint", fmt="parquet", path=f"{base}/out", name="progress")
        run.await_done(q)
        log.await_end(q.runId)
    return (progress.read_progress(spark, f"{base}/progress").groupBy("name")
            .agg(F.sum("input_rows").alias("input_rows"), F.count_distinct("batch_id").alias("batches"),
                 F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch")))


@query("str_archive", sql="SELECT event_type, count(*) AS n_out, count(*) AS n_kept FROM events GROUP BY event_type")
def str_archive(spark, d):
    """Input files that are archived once their batch is committed: what the sink holds, and what
    the archive and the rest of the input hold together."""
    base = scratch_path(spark, "str-archive")
    path, each = sources.replay_batches(Tables(spark, d).events, f"{base}/in", "ts", 6)
    s = sources.archiving_stream(stream_session(spark), path, "parquet", EVENTS_SCHEMA, f"{base}/archive",
                                 max_files_per_trigger=each)
    out = run.run_to_table(spark, s.select("event_id", "event_type"), "append", "str-archive-out")
    kept = sources.read_archived(spark, path, "parquet", EVENTS_SCHEMA, f"{base}/archive")
    return (out.groupBy("event_type").agg(F.count("*").alias("n_out"))
            .join(kept.groupBy("event_type").agg(F.count("*").alias("n_kept")), "event_type"))


@query("str_static_join", sql="""
    SELECT e.event_id, e.event_type, c.c_name, c.c_mktsegment FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
def str_static_join(spark, d):
    s = _events_stream(spark, d, "str-static")
    cust = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    j = st.enrich_static(s, cust, F.col("user_id") == F.col("c_custkey"))
    return run.run_to_table(spark, j.select("event_id", "event_type", "c_name", "c_mktsegment"), "append",
                            "str-static-out")
