"""Streaming: golden stock windows, late data, output-mode rules, builders and handles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corvid.session import scratch_path
from corvid.sources.files import from_local
from corvid.streaming import run, sinks, sources
from corvid.streaming import transforms as st

STOCK_SCHEMA = "CreatedTime STRING, Type STRING, Amount INT, BrokerCode STRING"
# The stock orders of 2022-05-09 (time, type, amount) from the teaching files.
DAY1 = [("10:05", "BUY", 500), ("10:12", "BUY", 300), ("10:20", "BUY", 800), ("10:40", "BUY", 900),
        ("10:25", "SELL", 400), ("10:48", "SELL", 600), ("10:50", "SELL", 100)]
DAY1_LATE = [("12:50", "BUY", 150)]


def _write(spark, path, rows):
    df = from_local(spark, [(f"2022-05-09 {t}:00", ty, a, "B1") for t, ty, a in rows], STOCK_SCHEMA)
    df.coalesce(1).write.mode("overwrite").json(path)


def _stock_windows(spark, batches, watermark="30 minutes"):
    base = scratch_path(spark, "stock")
    for i, rows in enumerate(batches):
        _write(spark, f"{base}/in/b{i:03d}", rows)
    s = sources.file_stream(spark, f"{base}/in/b*", "json", STOCK_SCHEMA, max_files_per_trigger=1)
    s = s.withColumn("ts", F.to_timestamp("CreatedTime", "yyyy-MM-dd HH:mm:ss"))
    agg = st.buy_sell_windows(s, "ts", "15 minutes", "Type", "Amount", "BUY", "SELL", watermark=watermark)
    out = st.window_bounds(run.run_to_table(spark, agg, "append", "stock-out"))
    return {r.window_start.strftime("%H:%M"): (r.buys, r.sells) for r in out.collect()}


def test_stock_windows_append_emits_closed_windows(spark):
    got = _stock_windows(spark, [DAY1, DAY1_LATE])
    assert got == {"10:00": (800, 0), "10:15": (800, 400), "10:30": (900, 0), "10:45": (0, 700)}


def test_late_rows_within_threshold_kept_older_dropped(spark):
    # Late rows are judged against the watermark of the batch before the previous one
    # (Spark keeps one watermark for late input and one for eviction), so a neutral
    # on-time batch separates the first file from the late one.
    late = [("10:22", "BUY", 50), ("10:01", "BUY", 999)]
    got = _stock_windows(spark, [DAY1, [("10:51", "SELL", 0)], late, DAY1_LATE])
    assert got["10:15"] == (850, 400)
    assert got["10:00"] == (800, 0)


def test_complete_mode_equals_batch(spark):
    base = scratch_path(spark, "stock-complete")
    _write(spark, f"{base}/in/b000", DAY1)
    _write(spark, f"{base}/in/b001", DAY1_LATE)
    s = sources.file_stream(spark, f"{base}/in/b*", "json", STOCK_SCHEMA, max_files_per_trigger=1)
    out = run.run_to_table(spark, s.groupBy("Type").agg(F.sum("Amount").alias("total")), "complete", "c")
    assert {r.Type: r.total for r in out.collect()} == {"BUY": 2650, "SELL": 1100}


def test_builders_and_triggers():
    o = sources.kafka_options("b:9092", "invoices", "earliest", fail_on_data_loss=False)
    assert o["subscribe"] == "invoices" and o["failOnDataLoss"] == "false"
    with pytest.raises(ValueError):
        sources.kafka_options("b:9092", "t", "yesterday")
    assert sources.socket_options("localhost", 9999, True)["includeTimestamp"] == "true"
    assert sinks.kafka_sink_options("b:9092", "out", "/ck")["topic"] == "out"
    assert run.trigger_kwargs("processing_time", "1 minute") == {"processingTime": "1 minute"}
    assert run.trigger_kwargs("once") == {"availableNow": True}
    assert run.trigger_kwargs("continuous") == {"continuous": "1 second"}


def test_file_source_rejects_unknown_option(spark):
    with pytest.raises(ValueError):
        sources.file_stream(spark, "/nonexistent", "json", STOCK_SCHEMA, bogus="1")


def test_query_handle_status_and_memory_sink(spark):
    base = scratch_path(spark, "handle")
    _write(spark, f"{base}/in/b000", DAY1)
    s = sources.file_stream(spark, f"{base}/in/b*", "json", STOCK_SCHEMA, latestFirst="false")
    q = run.start(s, "append", f"{base}/_ck", fmt="memory", name="stock_mem")
    run.await_done(q, 120)
    info = run.status(q)
    assert info["name"] == "stock_mem" and not info["active"]
    assert spark.sql("SELECT count(*) AS n FROM stock_mem").first().n == 7


def test_encode_record_json_value(spark):
    df = from_local(spark, [("w", 3)], "word string, n long")
    r = sinks.encode_record(df, "word", value_cols=["word", "n"]).first()
    assert r.key == "w" and r.value == '{"word":"w","n":3}'


def test_rate_source_and_console_sink(spark):
    import time
    base = scratch_path(spark, "rate")
    q = run.start(sources.rate_stream(spark, rows_per_second=50, num_partitions=1), "append", f"{base}/_ck",
                  fmt="memory", name="rate_mem", trigger=run.trigger_kwargs("processing_time", "1 second"))
    try:
        time.sleep(4)
    finally:
        q.stop()
    assert spark.sql("SELECT count(*) AS n FROM rate_mem").first().n > 0
    _write(spark, f"{base}/in/b000", DAY1)
    s = sources.file_stream(spark, f"{base}/in/b*", "json", STOCK_SCHEMA)
    run.await_done(run.start(s, "append", f"{base}/_ck2", fmt="console"), 120)


def test_continuous_trigger_map_only(spark):
    import time
    base = scratch_path(spark, "continuous")
    # one rate partition: a continuous task holds its core for the query's lifetime
    s = sources.rate_stream(spark, rows_per_second=20, num_partitions=1).selectExpr("value * 2 AS v")
    q = run.start(s, "append", f"{base}/_ck", fmt="memory", name="cont_mem",
                  trigger=run.trigger_kwargs("continuous", "1 second"))
    try:
        time.sleep(8)
    finally:
        q.stop()
    rows = spark.sql("SELECT v FROM cont_mem").collect()
    assert rows and all(r.v % 2 == 0 for r in rows)


def test_file_source_options_pass_through(spark):
    base = scratch_path(spark, "opts")
    _write(spark, f"{base}/in/b000", DAY1)
    s = sources.file_stream(spark, f"{base}/in/b*", "json", STOCK_SCHEMA, max_files_per_trigger=1,
                            latestFirst="true", fileNameOnly="true", maxFileAge="7d")
    assert s.isStreaming
    out = run.run_to_table(spark, s, "append", "opts-out")
    assert out.count() == 7


def test_replay_keeps_rows_without_a_time_and_empty_frames(spark):
    schema = "id long, ts timestamp_ntz"
    rows = [(i, None if i % 10 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(100)]
    for data in (rows, rows[:1], rows[1:2], []):
        df = spark.createDataFrame(data, schema)
        path = sources.replay_files(df, scratch_path(spark, "replay-test"), "ts", 4)
        assert spark.read.schema(schema).parquet(path).count() == len(data)


def test_start_refuses_an_illegal_output_mode(spark, tmp_path):
    s = sources.rate_stream(spark)
    with pytest.raises(ValueError, match="not allowed"):
        run.start(s, "complete", str(tmp_path), fmt="memory", name="refused")
    assert not spark.streams.active
