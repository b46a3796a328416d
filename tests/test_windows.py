"""Skew-safe window operators against Spark's plain single-task Window on data where one
key holds far more than a third of the rows, with ties and NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.operators import windows


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(4000):
        k = "hot" if i < 2500 else rnd.choice(["a", "b", "c", None])
        v = None if rnd.random() < 0.05 else float(rnd.randint(0, 40))
        rows.append((k, rnd.randint(0, 3), i, v))
    return spark.createDataFrame(rows, "k string, g int, seq long, v double").repartition(5)


def _pairs(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_running_matches_window(spark, skewed):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = windows.running(skewed, ["k"], ["v desc", "seq"], {
            "s": ("sum", "v"), "c": ("count", "v"), "mx": ("max", "v"), "mn": ("min", "v"), "a": ("avg", "v")},
            max_group_rows=0)
        w = (Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), "seq")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        want = skewed.select("seq", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("c"),
                             F.max("v").over(w).alias("mx"), F.min("v").over(w).alias("mn"),
                             F.avg("v").over(w).alias("a"))
        cols = ["seq", "s", "c", "mx", "mn", "a"]
        assert _pairs(got, cols) == _pairs(want, cols)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_running_global_without_keys(spark, skewed):
    got = windows.running(skewed, [], ["seq"], {"s": ("sum", "v")})
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = skewed.select("seq", F.sum("v").over(w).alias("s"))
    assert _pairs(got, ["seq", "s"]) == _pairs(want, ["seq", "s"])


def test_ranks_match_window(spark, skewed):
    got = windows.ranks(skewed, ["k", "g"], ["v desc"], max_group_rows=0)
    w = Window.partitionBy("k", "g").orderBy(F.col("v").desc_nulls_last())
    want = skewed.select("seq", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    cols = ["seq", "rank", "dense_rank"]
    assert _pairs(got, cols) == _pairs(want, cols)


def test_hot_key_spreads_over_slices(spark, skewed):
    ranged = skewed.repartitionByRange(8, "k", "seq").withColumn("p", F.spark_partition_id())
    hot_slices = ranged.where("k = 'hot'").select("p").distinct().count()
    assert hot_slices > 1


def test_dense_index_is_consecutive(spark, skewed):
    idx = windows.dense_index(skewed, ["seq"], "i", start=1)
    got = sorted((r.seq, r.i) for r in idx.select("seq", "i").collect())
    assert [i for _, i in got] == list(range(1, 4001))


def test_top_one_per_group(spark, skewed):
    got = windows.top_one_per_group(skewed.where("v IS NOT NULL"), ["k"], "v", "seq", ["seq", "v"])
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), "seq")
    want = (skewed.where("v IS NOT NULL").withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("k", "seq", "v"))
    assert _pairs(got, ["k", "seq", "v"]) == _pairs(want, ["k", "seq", "v"])


def test_plain_path_below_threshold_agrees(spark, skewed):
    assert windows.largest_group(skewed, ["k"]) == 2500
    plain = windows.running(skewed, ["k"], ["seq"], {"s": ("sum", "v")}, max_group_rows=10_000)
    split = windows.running(skewed, ["k"], ["seq"], {"s": ("sum", "v")}, max_group_rows=0)
    assert _pairs(plain, ["seq", "s"]) == _pairs(split, ["seq", "s"])
    r1 = windows.ranks(skewed, ["k"], ["v desc"], max_group_rows=10_000)
    r2 = windows.ranks(skewed, ["k"], ["v desc"], max_group_rows=0)
    assert _pairs(r1, ["seq", "rank", "dense_rank"]) == _pairs(r2, ["seq", "rank", "dense_rank"])


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_slices_agree_between_branches_on_large_wide_frames(spark, coalesce):
    """300,000 rows, unused columns and many slices: every branch must see the same slices."""
    df = (spark.range(300_000).withColumn("o", F.xxhash64("id")).withColumn("k", (F.col("id") % 100 > 60).cast("int"))
          .withColumn("pad", F.sha2(F.col("id").cast("string"), 256)).withColumn("v", F.col("id") % 7).repartition(12))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = windows.dense_index(df, ["o"], start=1).agg(
            F.count("*"), F.min("row_idx"), F.max("row_idx"), F.count_distinct("row_idx")).first()
        assert tuple(got) == (300_000, 1, 300_000, 300_000)
        w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
        run = windows.running(df, ["k"], ["o"], {"s": ("sum", "v"), "m": ("max", "v")}, max_group_rows=0)
        want = df.withColumns({"ws": F.sum("v").over(w), "wm": F.max("v").over(w)}).select("id", "ws", "wm")
        assert run.join(want, "id").where("s = ws AND m = wm").count() == 300_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_top_one_with_a_text_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, 1, "q")], "g int, o int, t string")
    got = windows.top_one_per_group(df, ["g"], "o", "t", ["t"]).collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "q")]


@pytest.mark.parametrize("n_values", [1, 2, 7, 500])
def test_ranked_running_equals_spark(spark, n_values):
    """Values that run over many slices, NULL values and keys, a hot key, keys within a slice."""
    rng = random.Random(n_values)
    rows = [(rng.choice([1, 1, 1, None, 2, 3]), rng.choice([None, *range(n_values)]), i, rng.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long, i long, x long").repartition(9)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = windows.ranked_running(df, ["k"], ["v desc", "i"], {"s": ("sum", "x"), "m": ("max", "x"), "a": ("avg", "x")},
                                     max_group_rows=0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    by_value = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())
    by_row = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("x").over(by_row).alias("s"), F.max("x").over(by_row).alias("m"), F.avg("x").over(by_row).alias("a"),
                     F.rank().over(by_value).alias("rank"), F.dense_rank().over(by_value).alias("dense_rank")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert got[0].__fields__ == ["k", "v", "i", "x", "s", "m", "a", "rank", "dense_rank"]


def test_ranked_running_plain_and_without_keys(spark):
    df = spark.createDataFrame([(i % 3, i // 4, i) for i in range(200)], "k long, v long, i long")
    plain = windows.ranked_running(df, ["k"], ["v", "i"], {"n": ("count", "i")})
    split = windows.ranked_running(df, ["k"], ["v", "i"], {"n": ("count", "i")}, max_group_rows=0)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))
    whole = windows.ranked_running(df, [], ["v", "i"], {}, dense_rank=None).collect()
    assert {(r.v, r["rank"]) for r in whole} == {(v, 4 * v + 1) for v in range(50)}
    assert windows.ranked_running(df.limit(0), ["k"], ["v"], {}, max_group_rows=0).collect() == []
