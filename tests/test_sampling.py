"""Sampling rates, known layouts, partition contents and the kept-then-released shares."""

import math

import pytest
from pyspark.sql import functions as F

from corvid.operators import partition as par


@pytest.fixture(scope="module")
def many(spark):
    return spark.range(2_000_000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"))


def near(n, mean, sigmas=3.0):
    assert abs(n - mean) <= sigmas * math.sqrt(mean), (n, mean)


@pytest.mark.parametrize("fraction", [2e-5, 1.5e-4, 0.2])
def test_hash_sample_rates(many, fraction):
    near(par.hash_sample_by_key(many, "k", {"a": fraction, "b": fraction}, ["id"]).count(), 2_000_000 * fraction)


@pytest.mark.parametrize("fraction", [1e-9, -0.1, 1.5])
def test_hash_sample_refuses_what_it_cannot_draw(many, fraction):
    with pytest.raises(ValueError, match="fraction"):
        par.hash_sample_by_key(many, "k", {"a": fraction}, ["id"])


@pytest.mark.parametrize("mean,rows", [(2e-5, 1_000_000), (0.3, 1_000_000), (150.0, 4000), (800.0, 2000), (5000.0, 300)])
def test_poisson_repeats(many, mean, rows):
    """Mean and variance of the repeats, below and beyond the point where exp(-mean) is 0."""
    one = many.where((F.col("k") == "a") & (F.col("id") < 2 * rows))
    reps = par.sample_by_key(one, "k", {"a": mean}, with_replacement=True).groupBy("id").count()
    n, squares = reps.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
    near(n, rows * mean, 4)
    if mean >= 150:
        variance = squares / rows - (n / rows) ** 2
        assert abs(variance / mean - 1) < 5 * math.sqrt(2 / rows)
        assert reps.select("count").distinct().count() > 10


def test_poisson_leaves_other_strata_out_and_refuses(many):
    got = par.sample_by_key(many.limit(1000), "k", {"b": 2.0, "c": 1000.0}, with_replacement=True)
    assert {r.k for r in got.select("k").distinct().collect()} == {"b"}
    assert par.sample_by_key(many, "k", {}, with_replacement=True).count() == 0
    with pytest.raises(ValueError, match="out of range"):
        par.sample_by_key(many, "k", {"a": 1e6}, with_replacement=True)


def test_layout_is_known(spark):
    df = spark.range(-50, 5000).withColumn("_pid", F.lit(0))
    laid = par.laid_out(df, "id", 7)
    assert laid.rdd.getNumPartitions() == 7
    assert laid.where(F.spark_partition_id() != F.pmod("id", F.lit(7))).isEmpty()


@pytest.mark.parametrize("max_items", [1, 64, 10_000])
def test_contents_are_bounded_and_whole(spark, max_items):
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"), "id")
    laid = par.laid_out(df, "id", 3).sortWithinPartitions("id")
    rows = par.contents(laid, "v", max_items).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.partition, r.chunk)):
        assert 0 < len(r["values"]) <= max_items
        got.setdefault(r.partition, []).extend(r["values"])
    assert got == {p: [i if i % 10 else None for i in range(p, 3000, 3)] for p in range(3)}
    assert "Exchange" not in par.contents(df, "v")._jdf.queryExecution().executedPlan().toString()


def test_shares_reads_once_and_releases(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 4 as k").write.parquet(f"{tmp_path}/t")
    got = par.shares(spark.read.parquet(f"{tmp_path}/t"), ["k"])
    assert {r.k: (r.n, r.share) for r in got.collect()} == {i: (250, 0.25) for i in range(4)}
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    assert par.shares(spark.read.parquet(f"{tmp_path}/t").limit(0), ["k"]).count() == 0
