"""Keyed state with timers, tables changed by batches, the sink of single rows, progress rows,
archived input: what they hold after late rows, retries and kills."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corvid.operators.sessions import sessions
from corvid.session import scratch_path
from corvid.streaming import progress, rows, run, sources, spans, storage, tables
from corvid.streaming import transforms as st
from corvid.streaming.sessions import stream_session

SCHEMA = "k long, ts timestamp"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def write_batches(spark, base, batches, schema=SCHEMA):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{base}/in/b{i:03d}")
    return f"{base}/in/b*"


def brute_spans(data, idle):
    out = []
    for k in {k for k, _ in data}:
        times = sorted(t for key, t in data if key == k and t is not None)
        for t in times:
            if out and out[-1][0] == k and t - out[-1][2] < idle:
                out[-1] = (k, out[-1][1], t, out[-1][3] + 1)
            else:
                out.append((k, t, t, 1))
    return sorted(out, key=str)


# ---- spans ----

def test_merge_spans():
    assert spans.merge_spans([(10, 12, 2), (0, 1, 1), (5, 9, 3)], 4) == [(0, 1, 1), (5, 12, 5)]
    assert spans.merge_spans([(0, 100, 5), (10, 20, 1)], 1) == [(0, 100, 6)]
    assert spans.merge_spans([(0, 0, 1), (4, 4, 1)], 4) == [(0, 0, 1), (4, 4, 1)]


def _random_batches(n_keys, seed=3):
    """Rows up to 20 hours out of order, some without a time, a hot key with half of the rows."""
    rng = random.Random(seed)
    batches = []
    for b in range(4):
        batch = [(rng.choice([0, rng.randrange(n_keys)]), at(b * 60 + rng.uniform(-20, 60))) for _ in range(150)]
        batches.append(batch + [(None, at(b * 60)), (1, None)])
    return batches


@pytest.mark.parametrize("mode", ["append", "update"])
def test_spans_of_rows_out_of_order(spark, mode):
    """The watermark is 100 hours behind, so nothing is late; update mode takes back spans that a
    row joined to an earlier one."""
    base, own = scratch_path(spark, "spans"), stream_session(spark, state_partitions=2)
    batches = _random_batches(12) + [[(99, at(2000))], [(99, at(2001))]]
    path = write_batches(spark, base, batches)
    df = spans.activity_spans(sources.file_stream(own, path, "parquet", SCHEMA, 1), "k", "ts", "3 hours", "100 hours", mode)
    out = run.run_to_table(spark, df, mode, "spans-out", keys=["k", "first"])
    got = sorted(((r.k, r.first, r.last, r.n) for r in out.collect() if r.n), key=str)
    want = brute_spans([r for b in batches for r in b if r[1] is not None], dt.timedelta(hours=3))
    assert got == [w for w in want if w[0] != 99 or mode == "update"]


def test_state_shrinks_and_late_rows_are_left_out(spark):
    base, own = scratch_path(spark, "shrink"), stream_session(spark, state_partitions=2)
    many = [(k, at(0.01 * k)) for k in range(200)]
    path = write_batches(spark, base, [many, [(1000, at(50))], [(1001, at(100)), (5, at(0.05))], [(1002, at(150))]])
    df = spans.activity_spans(sources.file_stream(own, path, "parquet", SCHEMA, 1), "k", "ts", "2 hours", "1 hour")
    with progress.logged(own, f"{base}/progress") as log:
        q = run.start(df, "append", f"{base}/_ck", fmt="parquet", path=f"{base}/out", name="shrink")
        run.await_done(q)
        log.await_end(q.runId)
    held = [r.state_rows for r in progress.read_progress(spark, f"{base}/progress").orderBy("batch_id").collect()]
    assert max(held[:2]) >= 200 and held[-1] < 10
    out = spark.read.parquet(f"{base}/out")
    assert out.where("k < 200").count() == 200 and out.where("k = 5").first().n == 1


def test_spans_restart_from_their_state(spark):
    base, own = scratch_path(spark, "span-restart"), stream_session(spark, state_partitions=2)

    def once():
        df = sources.file_stream(own, f"{base}/in/b*", "parquet", SCHEMA, 1)
        df = spans.activity_spans(df, "k", "ts", "3 hours", "1 hour")
        run.await_done(run.start(df, "append", f"{base}/_ck", fmt="parquet", path=f"{base}/out"))

    spark.createDataFrame([(1, at(0)), (2, at(0))], SCHEMA).coalesce(1).write.parquet(f"{base}/in/b000")
    once()
    spark.createDataFrame([(1, at(1)), (3, at(30))], SCHEMA).coalesce(1).write.parquet(f"{base}/in/b001")
    once()
    got = sorted((r.k, r.first, r.last, r.n) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(1, at(0), at(1), 2), (2, at(0), at(0), 1)]


class _State:
    """A key's state and timers, and the calls that went to the store."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def __getattr__(self, name):
        def called(*args):
            self.calls += 1
            if name in ("getValueState", "getListState"):
                return self
            if name in ("update", "put"):
                self.value = args[0]
            elif name == "clear":
                self.value = None
            elif name == "registerTimer":
                self.timers.add(args[0])
            elif name == "deleteTimer":
                self.timers.remove(args[0])
            return self.value if name == "get" else iter(sorted(self.timers)) if name == "listTimers" else None
        return called


class _Watermark:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_a_key_costs_few_calls_to_its_state(spark):
    """However many spans it has: a call each to read and to store them, and to move the timer."""
    state, key = _State(), ("=1",)
    keyed = spans.Spans(1_000_000, "update")
    keyed.init(state)
    for batch in range(3):
        state.calls, watermark = 0, _Watermark(max(0, batch * 1000 - 1) * 5000)
        out = list(keyed.handleInputRows(key, iter([Row(at=at * 5_000_000) for at in range(batch * 1000, batch * 1000 + 1000)]), watermark))
        assert len(out) == 1000 and {r.n for r in out} == {1} and state.calls <= 4
        assert state.timers == {min(state.value[1]) // 1000 + 1000} and len(state.value[0]) == 1000 + bool(batch)
        state.calls, over = 0, _Watermark((batch * 1000 + 999) * 5000)
        fired = [at for at in state.timers if at <= over.getCurrentWatermarkInMs()]
        for at in fired:
            assert list(keyed.handleExpiredTimer(key, over, None)) == []
            state.timers.remove(at)  # as Spark does
        assert state.calls <= 3 and len(state.value[0]) == len(state.timers) == 1


def test_rows_of_a_key_come_in_portions(spark, monkeypatch):
    monkeypatch.setattr(spans, "_ROWS", 7)
    rng = random.Random(5)
    times = [rng.randrange(0, 3000) for _ in range(500)]
    state = _State()
    keyed = spans.Spans(4, "update")
    keyed.init(state)
    # the first portions hold late rows only
    out = list(keyed.handleInputRows(("=1",), iter([Row(at=at) for at in [0] * 30 + [at + 1000 for at in times]]), _Watermark(1)))
    assert [tuple(r)[1:] for r in out] == spans.merge_spans([(at + 1000, at + 1000, 1) for at in times], 4)


def test_spans_refuse_other_modes(spark):
    with pytest.raises(ValueError, match="append or update"):
        spans.activity_spans(sources.rate_stream(spark), "value", "timestamp", "1 hour", "1 hour", "complete")


# ---- sessions ----

@pytest.mark.parametrize("slices", [1, 3, 40])
def test_batch_sessions_with_a_hot_key(spark, slices):
    rng = random.Random(1)
    data = [(rng.choice([7, 7, 7, None, *range(5)]), rng.choice([None, at(rng.uniform(0, 3000))])) for _ in range(4000)]
    got = sessions(spark.createDataFrame(data, SCHEMA), ["k"], "ts", "1 HOUR", slices).collect()
    want = brute_spans([r for r in data if r[1] is not None], dt.timedelta(hours=1))
    assert sorted(map(tuple, got), key=str) == want


def test_one_long_session_over_many_slices(spark):
    data = [(1, at(i / 10)) for i in range(3000)]
    got = sessions(spark.createDataFrame(data, SCHEMA), ["k"], "ts", "1 HOUR", 16).collect()
    assert list(map(tuple, got)) == [(1, at(0), at(299.9), 3000)]
    assert sessions(spark.createDataFrame([], SCHEMA), ["k"], "ts", "1 HOUR").count() == 0


def test_stream_sessions_merge_before_the_shuffle(spark):
    """Half of all rows are one user's; each task hands on sessions, not rows."""
    base, own = scratch_path(spark, "stream-sessions"), stream_session(spark, state_partitions=2)
    path = write_batches(spark, base, _random_batches(8))
    s = sources.file_stream(own, path, "parquet", SCHEMA, 1)
    q = run.start(st.session_counts(s, "ts", "3 hours", ["k"], watermark="100 hours"), "append", f"{base}/_ck", fmt="noop")
    run.await_done(q)
    plan = q._jsq.explainInternal(False)
    # the plan is printed from the top: the state store, the exchange by key, the merge in each task
    assert plan.index("SessionWindowStateStoreSave") < plan.index("Exchange hashpartitioning")
    assert "MergingSessions" in plan[plan.index("Exchange hashpartitioning"):]


# ---- tables ----

def _rows(spark, pairs):
    return spark.createDataFrame(pairs, "word string, n long")


def test_upserts_touch_their_buckets_only(spark):
    table = tables.UpsertTable(spark, scratch_path(spark, "upsert"), ["word"], buckets=8, max_deltas=2)
    want = {}
    for version in range(12):
        batch = {f"w{i}": version * 100 + i for i in range(version, version + 3)} | ({None: version} if version % 3 else {})
        before = table.manifest()
        table.write(_rows(spark, list(batch.items())), version)
        want |= batch
        after = table.manifest()
        assert {r.word: r.n for r in table.read(spark).collect()} == want
        assert all(len(parts) <= 3 for parts in after["parts"].values())
        changed = {b for b, parts in after["parts"].items() if not before or before["parts"].get(b) != parts}
        assert len(changed) <= len(batch)
    assert table.read(spark).dtypes == [("word", "string"), ("n", "bigint")]
    kept = storage.Files(spark, table.path).names("data")
    assert len(kept) <= 3 * 8 + 2


@pytest.mark.parametrize("step", ["_save", "_switch"])
def test_killed_batch_leaves_the_old_table(spark, monkeypatch, step):
    table = tables.UpsertTable(spark, scratch_path(spark, "upsert-kill"), ["word"], buckets=4)
    table.write(_rows(spark, [("a", 1), ("b", 2)]), 0)

    def killed(*_):
        raise KeyboardInterrupt("killed")

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(table, step, killed)
        table.write(_rows(spark, [("a", 10), ("c", 3)]), 1)
    assert {r.word: r.n for r in table.read(spark).collect()} == {"a": 1, "b": 2}
    table.write(_rows(spark, [("a", 10), ("c", 3)]), 1)
    table.write(_rows(spark, [("a", -1)]), 1)  # comes again after its commit
    assert {r.word: r.n for r in table.read(spark).collect()} == {"a": 10, "b": 2, "c": 3}


def test_replaced_table_is_read_while_it_changes(spark):
    table = tables.SnapshotTable(spark, scratch_path(spark, "snapshot"))
    with pytest.raises(ValueError, match="no batch"):
        table.read(spark)
    table.write(_rows(spark, [("a", 1)]), 0)
    old = table.read(spark)
    table.write(_rows(spark, [("b", 2)]), 1)
    assert [r.word for r in old.collect()] == ["a"] and [r.word for r in table.read(spark).collect()] == ["b"]
    table.write(_rows(spark, [("z", 9)]), 1)
    assert [r.word for r in table.read(spark).collect()] == ["b"]


def test_upsert_refuses_another_layout(spark):
    path = scratch_path(spark, "upsert-layout")
    tables.UpsertTable(spark, path, ["word"], buckets=4).write(_rows(spark, [("a", 1)]), 0)
    with pytest.raises(ValueError, match="buckets"):
        tables.UpsertTable(spark, path, ["word"], buckets=5).write(_rows(spark, [("a", 1)]), 1)
    empty = tables.UpsertTable(spark, scratch_path(spark, "upsert-empty"), ["word"])
    empty.write(_rows(spark, []), 0)
    assert empty.read(spark).count() == 0


# ---- single rows ----

ROWS = "id long, name string, value double"


def _row_stream(spark, base, n_files=3):
    for i in range(n_files):
        df = spark.range(i * 1000, i * 1000 + 1000).selectExpr("id", "if(id % 7 = 0, null, concat('n\\n\"é', id)) name", "id / 8 value")
        df.repartition(2).write.parquet(f"{base}/in/b{i:03d}")
    return sources.file_stream(spark, f"{base}/in/b*", "parquet", ROWS, max_files_per_trigger=2)


def _expected(n):
    return [(i, None if i % 7 == 0 else f'n\n"é{i}', i / 8) for i in range(n)]


def _forget_last_commit(spark, checkpoint):
    """As if the query had died after its sink's commit and before its own."""
    files = storage.Files(spark, f"{checkpoint}/commits")
    last = max((n for n in files.names() if n.isdigit()), key=int)
    files.remove(last)
    return last


def test_rows_once_after_a_forced_retry(spark):
    base = scratch_path(spark, "rows")
    writer = rows.RowFiles(f"{base}/out", _row_stream(spark, base).schema)

    def once():
        s = sources.file_stream(spark, f"{base}/in/b*", "parquet", ROWS, max_files_per_trigger=2)
        run.await_done(run.start(s, "append", f"{base}/_ck", foreach=writer))

    once()
    _forget_last_commit(spark, f"{base}/_ck")
    once()
    got = sorted(map(tuple, rows.read_rows(spark, f"{base}/out", ROWS).collect()))
    assert got == _expected(3000)


def test_failed_attempt_leaves_nothing(spark):
    base = scratch_path(spark, "rows-fail")
    s = _row_stream(spark, base, 1)

    class Failing(rows.RowFiles):
        def process(self, row):
            if row["id"] == 900:
                raise ValueError("no such row")
            super().process(row)

    with pytest.raises(Exception, match="no such row"):
        run.await_done(run.start(s, "append", f"{base}/_ck", foreach=Failing(f"{base}/out", s.schema)))
    s = sources.file_stream(spark, f"{base}/in/b*", "parquet", ROWS)
    run.await_done(run.start(s, "append", f"{base}/_ck", foreach=rows.RowFiles(f"{base}/out", s.schema)))
    assert sorted(map(tuple, rows.read_rows(spark, f"{base}/out", ROWS).collect())) == _expected(1000)


# ---- progress, triggers, archive, order ----

def test_progress_of_a_fixed_interval(spark):
    base, own = scratch_path(spark, "interval"), stream_session(spark)
    path = write_batches(spark, base, [[(1, at(i))] for i in range(3)])
    s = sources.file_stream(own, path, "parquet", SCHEMA, 1)
    with progress.logged(own, f"{base}/progress") as log:
        q = run.start(s, "append", f"{base}/_ck", fmt="noop", name="interval",
                      trigger=run.trigger_kwargs("processing_time", "2 seconds"))
        q.processAllAvailable()
        q.stop()
        log.await_end(q.runId)
    got = progress.read_progress(spark, f"{base}/progress").where("input_rows > 0").orderBy("batch_id").collect()
    assert [r.batch_id for r in got] == [0, 1, 2] and all(r.input_rows == 1 for r in got)
    # batches after the first begin at whole multiples of the interval
    assert all(r["at"].timestamp() % 2 < 0.9 for r in got[1:]), got


def test_archive_and_rest_are_the_input(spark):
    base = scratch_path(spark, "archive")
    df = spark.range(5000).selectExpr("id as k", "timestamp_seconds(id * 60) as ts")
    path = sources.replay_files(df, f"{base}/in", "ts", 5)
    s = sources.archiving_stream(stream_session(spark), path, "parquet", SCHEMA, f"{base}/archive", max_files_per_trigger=1)
    out = run.run_to_table(spark, s, "append", "archive-out")
    assert out.count() == 5000
    kept = sources.read_archived(spark, path, "parquet", SCHEMA, f"{base}/archive")
    assert sorted(r.k for r in kept.collect()) == list(range(5000))
    moved = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/archive").count()
    assert 0 < moved <= 5000


@pytest.mark.parametrize("latest", ["false", "true"])
def test_order_of_files(spark, latest):
    base = scratch_path(spark, "order")
    df = spark.range(4000).selectExpr("id as k", "timestamp_seconds(id * 60) as ts")
    path = sources.replay_files(df, f"{base}/in", "ts", 4)
    s = sources.file_stream(spark, path, "parquet", SCHEMA, 1, latestFirst=latest, fileNameOnly="true", maxFileAge="1d")
    seen = []
    run.await_done(run.start(s, "append", f"{base}/_ck", foreach_batch=lambda b, i: seen.append(b.agg(F.min("k")).first()[0])))
    assert len(seen) == 4 and seen == sorted(seen, reverse=latest == "true")


def test_replay_orders_rows_by_time(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else at(-i)) for i in range(1000)], SCHEMA)
    base = scratch_path(spark, "replay-order")
    path = sources.replay_files(df, base, "ts", 4)
    seen = []
    s = sources.file_stream(spark, path, "parquet", SCHEMA, 1)
    run.await_done(run.start(s, "append", f"{base}/_ck", foreach_batch=lambda b, i: seen.append(
        b.agg(F.min("ts"), F.max("ts"), F.count("*"), F.count_if(F.col("ts").isNull())).first())))
    assert sum(r[2] for r in seen) == 1000 and seen[0][3] == 100 and all(r[3] == 0 for r in seen[1:])
    assert all(a[1] <= b[0] for a, b in zip(seen, seen[1:]))


def test_replayed_batches_of_several_files(spark, monkeypatch):
    """As many batches as asked for and rows in order of time, whatever the number of files of a batch;
    a file is written by one task, so their size is bounded, that of one time's rows too."""
    monkeypatch.setattr(sources, "FILE_BYTES", 1 << 13)
    base = scratch_path(spark, "replay-batches")
    rows = [(i, None if i % 10 == 0 else at(i % 500) if i % 2 else at(77)) for i in range(20_000)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/table")
    table = spark.read.parquet(f"{base}/table")
    path, each = sources.replay_batches(table.join(table.select("k"), "k"), f"{base}/in", "ts", 3, inputs=[table])
    names = [n for n in storage.Files(spark, f"{base}/in").names("b") if n.startswith("part-")]
    assert each > 1 and 2 * each < len(names) <= 3 * each
    held = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(held) < 2 * 20_000 / len(names)
    seen = []
    s = sources.file_stream(spark, path, "parquet", SCHEMA, each)
    run.await_done(run.start(s, "append", f"{base}/_ck", foreach_batch=lambda b, i: seen.append(
        b.agg(F.min("ts"), F.max("ts"), F.count("*"), F.count_if(F.col("ts").isNull())).first())))
    assert len(seen) == 3 and sum(r[2] for r in seen) == 20_000 and [r[3] for r in seen] == [2000, 0, 0]
    assert all(a[1] <= b[0] for a, b in zip(seen, seen[1:]))
    few = spark.createDataFrame(rows[:50], SCHEMA)  # no size estimate
    path, each = sources.replay_batches(few, f"{base}/few", "ts", 4)
    assert spark.read.parquet(path).count() == 50 and 4 * each <= 4 * spark.sparkContext.defaultParallelism
    assert sources.replay_batches(spark.range(50).selectExpr("id k", "timestamp_seconds(id) ts"), f"{base}/one", "ts", 4)[1] == 1


def test_replaying_query_keeps_its_batches(spark, monkeypatch):
    from corvid.plans.registry import all_queries
    base = scratch_path(spark, "replay-query")
    spark.range(5000).selectExpr("id event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) ts", "id % 7 user_id",
                                 "'view' event_type", "id / 3 value", "'{}' props").write.parquet(f"{base}/events.parquet")
    monkeypatch.setattr(sources, "FILE_BYTES", 1 << 13)
    asked, whole = [], sources.file_stream
    monkeypatch.setattr(sources, "file_stream", lambda *a, **k: asked.append(k["max_files_per_trigger"]) or whole(*a, **k))
    (got,) = all_queries()["str_progress"](spark, base).collect()
    assert asked[0] > 1 and (got.input_rows, got.batches, got.last_batch) == (5000, 4, 3)
