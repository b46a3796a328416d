from pyspark.sql import functions as F

from corvid.operators import partition as par
from corvid.session import scratch_path
from corvid.sources import files
from corvid.sources.tables import Tables

from testdata import SF_CHECK


def test_hash_split_is_disjoint_complete_and_stable(spark):
    o = Tables(spark, SF_CHECK).orders.select("o_orderkey")
    a, b = par.hash_split(o, "o_orderkey", [0.4, 0.6])
    a2, _ = par.hash_split(o, "o_orderkey", [0.4, 0.6])
    na, nb = a.count(), b.count()
    assert na + nb == o.count() and a.join(b, "o_orderkey").count() == 0
    assert 0.35 < na / (na + nb) < 0.45
    assert a.exceptAll(a2).count() == 0


def test_random_split_and_samples(spark):
    o = Tables(spark, SF_CHECK).orders.select("o_orderkey")
    parts = par.random_split(o, [0.4, 0.6], seed=3)
    assert sum(p.count() for p in parts) == o.count()
    s = par.sample_n_with_replacement(o, 50, o.count(), seed=5)
    assert s.count() == 50
    strat = par.sample_by_key(Tables(spark, SF_CHECK).lineitem, "l_returnflag", {"R": 0.5}, with_replacement=True)
    flags = {r.l_returnflag for r in strat.select("l_returnflag").distinct().collect()}
    assert flags == {"R"}
    n_r = Tables(spark, SF_CHECK).lineitem.where("l_returnflag = 'R'").count()
    assert 0.4 * n_r < strat.count() < 0.6 * n_r


def test_sort_within_buckets(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    out = par.sorted_within_buckets(df, (F.col("k") % 2).cast("int"), 2, ["k"]).collect()
    assert all(r.partition == r.k % 2 for r in out)
    assert {(r.k, r.pos) for r in out if r.k % 2 == 0} == {(2 * i, i + 1) for i in range(50)}


def test_partial_sums_cover_everything(spark):
    li = Tables(spark, SF_CHECK).lineitem.repartition(5)
    parts = par.partial_sums(li, "l_quantity").collect()
    assert len(parts) == 5 and sum(p.n for p in parts) == li.count()


def test_local_rows_schema_rows_and_whole_files(spark):
    df = files.from_local(spark, [(1, "a"), (2, "b")], "id int, s string", num_partitions=2)
    assert df.rdd.getNumPartitions() == 2
    sch = {r.column: r.type for r in files.schema_rows(df).collect()}
    assert sch == {"id": "int", "s": "string"}
    path = files.write_text(df, "s", scratch_path(spark, "whole"))
    whole = files.read_whole_files(spark, path).collect()
    assert sorted("".join(r.content for r in whole).split()) == ["a", "b"]


def test_checkpoint_dir_is_shared_setting(spark):
    from corvid.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_pandas_export_guard_and_foreach_partition(spark):
    import pytest
    df = spark.range(20)
    assert len(files.to_pandas_guarded(df, 20)) == 20
    with pytest.raises(ValueError):
        files.to_pandas_guarded(df, 5)
    acc = spark.sparkContext.accumulator(0)

    def count_rows(rows):
        acc.add(sum(1 for _ in rows))
    files.for_each_partition(df.repartition(3), count_rows)
    assert acc.value == 20


def test_sampling_with_replacement_is_unbiased(spark):
    """Stratum mean and variance of the repeats within 4 sigma of Poisson, also above 1."""
    n = 200_000
    df = spark.range(n).withColumn("k", F.lit("a"))
    for fraction in (0.2, 1.0, 3.0):
        drawn = par.sample_by_key(df, "k", {"a": fraction}, with_replacement=True).groupBy("id").count()
        total, squares = drawn.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
        assert abs(total - n * fraction) < 4 * (n * fraction) ** 0.5
        variance = squares / n - (total / n) ** 2
        assert abs(variance - fraction) < 4 * ((fraction + 2 * fraction ** 2) / n) ** 0.5


def test_exactly_n_draws(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    for n in (1, 50, 500):
        got = par.sample_n_with_replacement(df, n, 100)
        assert got.columns == ["id", "x"] and got.count() == n
    assert par.sample_n_with_replacement(df.limit(0), 5, 0).count() == 0


def test_split_keeps_small_weights(spark):
    parts = par.hash_split(spark.range(100_000), "id", [0.001, 0.999])
    assert 50 < parts[0].count() < 200 and sum(p.count() for p in parts) == 100_000
