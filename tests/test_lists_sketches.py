"""Cogroup with both lists, stored sketches, number ranges, and slices of a stream's own sink."""

import random

import pytest
from pyspark.sql import functions as F

from corvid.operators import joins, sketches
from corvid.session import scratch_path
from corvid.sources import files
from corvid.streaming import weather
from corvid.streaming.sessions import stream_session


def _lists(rows, items):
    out = {}
    for k in {k for k, _ in rows}:
        vs = sorted((v for key, v in rows if key == k), key=lambda v: (v is not None, v))
        for c in range(0, len(vs), items):
            part = vs[c: c + items]
            out[k, c // items] = (len(part), [v for v in part if v is not None])
    return out


@pytest.mark.parametrize("items", [1, 7, 1000])
def test_cogroup_lists_against_brute_force(spark, items):
    """Half of the left rows are one key's; keys on one side only, NULL keys, NULL and repeated values."""
    rng = random.Random(items)
    left = [(rng.choice([1, 1, 1, None, *range(2, 9)]), rng.choice([None, rng.randrange(50)])) for _ in range(400)]
    right = [(rng.choice([1, None, *range(5, 14)]), rng.choice([None, f"v{rng.randrange(9)}"])) for _ in range(150)]
    got = joins.cogroup_lists(spark.createDataFrame(left, "k long, v long"), spark.createDataFrame(right, "u long, w string"),
                              "k", "v", "w", right_key="u", max_items=items)
    a, b = _lists(left, items), _lists(right, items)
    want = sorted(((*key, *a.get(key, (0, [])), *b.get(key, (0, []))) for key in a.keys() | b.keys()), key=str)
    rows = got.collect()
    assert sorted(map(tuple, rows), key=str) == want
    assert all(len(r.left_values) <= items and len(r.right_values) <= items for r in rows)


def test_cogroup_lists_of_empty_sides(spark):
    some, none = spark.createDataFrame([(1, 2)], "k long, v long"), spark.createDataFrame([], "k long, v long")
    assert list(map(tuple, joins.cogroup_lists(some, none, "k", "v", "v").collect())) == [(1, 0, 1, [2], 0, [])]
    assert list(map(tuple, joins.cogroup_lists(none, some, "k", "v", "v").collect())) == [(1, 0, 0, [], 1, [2])]
    assert joins.cogroup_lists(none, none, "k", "v", "v").count() == 0


def test_sketch_sizes():
    assert [sketches.lg_k(r) for r in (0.1, 0.02, 0.01, 0.5, 1e-4)] == [7, 12, 14, 4, 21]
    for rsd in (0.3, 0.1, 0.05, 0.02):
        assert 1.04 / 2 ** (sketches.lg_k(rsd) / 2) <= rsd
    with pytest.raises(ValueError):
        sketches.lg_k(0)


@pytest.fixture(scope="module")
def visits(spark):
    return spark.range(200_000).select((F.col("id") % 10).cast("int").alias("day"), (F.col("id") % 3).alias("k"),
                                       F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id"), F.lit(30_000))).alias("user"))


@pytest.mark.parametrize("rsd", [0.1, 0.02])
def test_united_sketches_are_within_their_bound(spark, visits, rsd):
    path = sketches.store(visits, scratch_path(spark, "sk"), "day", ["k"], "user", rsd)
    for where in (None, F.col("day") < 3, F.col("day") == 9):
        got = sketches.estimates(spark, path, ["k"], where).collect()
        exact = (visits.where(where) if where is not None else visits).groupBy("k").agg(F.count_distinct("user").alias("n"))
        exact = {r.k: r.n for r in exact.collect()}
        assert {r.k for r in got} == set(exact)
        assert all(abs(r.distinct_values - exact[r.k]) <= 3 * rsd * exact[r.k] for r in got)


def test_union_equals_one_sketch_of_all(spark, visits):
    """Uniting loses nothing: the same estimate as from the rows at once."""
    path = sketches.store(visits, scratch_path(spark, "sk-all"), "day", ["k"], "user")
    whole = sketches.store(visits.withColumn("day", F.lit(0)), scratch_path(spark, "sk-one"), "day", ["k"], "user")
    united = [sketches.estimates(spark, p, ["k"]).orderBy("k").collect() for p in (path, whole)]
    for a, b in zip(*united):
        assert abs(a.distinct_values - b.distinct_values) <= 0.02 * b.distinct_values


def test_a_slice_loaded_again_replaces_itself(spark, visits):
    path = sketches.store(visits.where("day < 5"), scratch_path(spark, "sk-slices"), "day", ["k"], "user")
    before = sketches.estimates(spark, path, ["k"], F.col("day") == 2).orderBy("k").collect()
    sketches.store(visits.where("day = 4").limit(3), path, "day", ["k"], "user")
    sketches.store(visits.where("day = 7"), path, "day", ["k"], "user")
    assert sketches.estimates(spark, path, ["k"], F.col("day") == 2).orderBy("k").collect() == before
    assert spark.read.parquet(path).select("day").distinct().count() == 6
    assert sum(r.distinct_values for r in sketches.estimates(spark, path, ["k"], F.col("day") == 4).collect()) <= 3
    one = sketches.estimates(spark, path, ["k"], F.col("day") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in one


def test_number_range(spark):
    df = spark.createDataFrame([(3,), (-2,), (None,), (3,)], "v long")
    assert [r.number for r in files.number_range(df, "v").orderBy("number").collect()] == list(range(-2, 4))
    assert files.number_range(df.where("v is null"), "v").count() == 0


def test_slice_of_a_streams_own_sink(spark):
    base, own = scratch_path(spark, "weather-test"), stream_session(spark)
    rows = spark.range(2000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), F.col("id") % 4)).alias("city"),
                                    F.timestamp_seconds(1704067200 + F.col("id") * 600).alias("event_time"),
                                    F.col("id").cast("double").alias("temperature"))
    rows.write.parquet(f"{base}/in/b0")
    s = own.readStream.schema(rows.schema).parquet(f"{base}/in/b*")
    path = weather.run_weather_sink(spark, s, f"{base}/out", f"{base}/_ck")
    # a file that no batch has committed
    rows.select("event_time", "temperature").limit(5).write.mode("append").parquet(f"{path}/city=c1/day=2024-01-03")
    got = weather.weather_slice(spark, path, "c1", "2024-01-03 12:00:00", "2024-01-05")
    want = rows.where("city = 'c1' AND event_time >= '2024-01-03 12:00:00' AND event_time < '2024-01-05'")
    assert sorted(r.temperature for r in got.collect()) == sorted(r.temperature for r in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "city" in filters and "day" in filters
    assert "event_time" in plan[plan.index("PushedFilters"):]
