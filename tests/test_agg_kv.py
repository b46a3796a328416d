import pytest
from pyspark.sql import functions as F

from corvid.operators import agg, kv
from corvid.sources.tables import Tables

from testdata import SF_CHECK


def test_collect_bounded_splits_hot_groups(spark):
    rows = [("hot", i) for i in range(2500)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, v long")
    out = agg.collect_bounded(df, ["k"], "v", max_items=500)
    chunks = {r.k: [] for r in out.collect()}
    for r in out.collect():
        chunks[r.k].append(r)
    assert len(chunks["cold"]) == 1 and chunks["cold"][0].chunk == 0
    assert len(chunks["hot"]) == 5
    assert max(len(r["values"]) for r in chunks["hot"]) == 500
    assert sorted(v for r in chunks["hot"] for v in r["values"]) == list(range(2500))


def test_collect_bounded_with_few_distinct_values_and_null_keys(spark):
    rows = [("hot", i % 3) for i in range(1000)] + [(None, 7)]
    df = spark.createDataFrame(rows, "k string, v long")
    for limit in (None, 0):
        out = agg.collect_bounded(df, ["k"], "v", max_items=100, sets={"s": "v"}, max_group_rows=limit).collect()
        assert sorted(len(r["values"]) for r in out if r.k) == [100] * 10
        assert [(r["values"], r.s) for r in out if r.k is None] == [([7], [7])]


def test_collect_bounded_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v long")
    r = agg.collect_bounded(df, ["k"], "v", distinct=True).collect()[0]
    assert r["values"] == [1, 2] and r.n == 2


def test_approx_count_distinct_within_bound(spark):
    e = Tables(spark, SF_CHECK).events
    r = e.agg(F.approx_count_distinct("event_id", 0.1).alias("a"), F.count_distinct("event_id").alias("x")).first()
    assert abs(r.a - r.x) / r.x < 0.3


def test_text_stats_single_pass_matches_words(spark):
    docs = spark.createDataFrame([(1, "a bb\nccc data\n"), (2, "dddd  e")], "doc_id long, text string")
    r = kv.text_stats(docs).first()
    assert r.n_lines == 4 and r.n_words == 6 and r.longest_word == "data" and r.lines_with_needle == 1
    assert r.long_words == 0 and r.longest_line == 8


def test_argmax_reports_all_ties(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("z", 9.0)], "c string, d double")
    out = {r.c: r.is_max for r in kv.fail_counts(df, "c", F.col("d") < 5).collect()}
    assert out == {"x": True, "y": True, "z": False}


@pytest.mark.parametrize("clean,expected", [(False, {"Hola,": 1, "hola": 1, "mundo.": 1}),
                                            (True, {"hola": 2, "mundo": 1})])
def test_word_count_variants(spark, clean, expected):
    df = spark.createDataFrame([("Hola, hola  mundo.",)], "text string")
    assert {r.word: r.n for r in kv.word_count(df, clean=clean).collect()} == expected


def test_full_outer_rewrite_equals_full_outer(spark):
    from corvid.operators.joins import full_outer_using
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n"), (4, "d"), (4, "e")], "k int, a string")
    b = spark.createDataFrame([(2, 10), (2, 11), (3, 12), (None, 13), (4, 14)] + [(9, i) for i in range(50)],
                              "k int, b int")
    got = sorted(map(tuple, full_outer_using(a, b, ["k"]).collect()), key=str)
    want = sorted(map(tuple, a.join(b, ["k"], "full_outer").select("k", "a", "b").collect()), key=str)
    assert got == want


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_decomposition_equals_spark(spark, how):
    from corvid.operators.joins import outer_join
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n"), (4, "d"), (4, "e")] + [(7, "h")] * 30,
                              "ka int, a string")
    b = spark.createDataFrame([(2, 10), (2, 11), (3, 12), (None, 13), (4, 14)] + [(7, i) for i in range(40)],
                              "kb int, b int")
    got = sorted(map(tuple, outer_join(a, b, "ka", "kb", how).select("ka", "a", "kb", "b").collect()), key=str)
    want = sorted(map(tuple, a.join(b, a.ka == b.kb, how).select("ka", "a", "kb", "b").collect()), key=str)
    assert got == want


def test_cogroup_groups_null_keys_once(spark):
    from corvid.operators.joins import cogroup_stats
    a = spark.createDataFrame([(None, 1), (None, 2), (1, 5)], "k int, v int")
    b = spark.createDataFrame([(None, 10), (2, 7)], "k int, v int")
    out = {r.k: (r.left_n, r.left_sum, r.right_n, r.right_sum) for r in cogroup_stats(a, b, "k", "v", "v").collect()}
    assert out == {None: (2, 3, 1, 10), 1: (1, 5, 0, None), 2: (0, None, 1, 7)}


def test_outer_join_of_unique_keys_reads_each_side_once(spark):
    from corvid.operators.joins import full_outer_chain
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(2, "x"), (3, "y"), (None, "m")], "k int, b string")
    c = spark.createDataFrame([(3, "p"), (4, "q")], "k int, c string")
    plain = sorted(map(tuple, full_outer_chain([a, b, c], "k").collect()), key=str)
    native = full_outer_chain([a, b, c], "k", unique=True)
    assert sorted(map(tuple, native.collect()), key=str) == plain and len(plain) == 6
    assert native._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 2


def test_pivot_sums_keeps_other_and_missing_values(spark):
    from corvid.operators.agg import pivot_sums
    df = spark.createDataFrame([("g", "F", 1, 2.0), ("g", "Z", 3, 4.0), ("g", None, 5, 6.0)], "g string, s string, x int, y double")
    assert pivot_sums(df, ["g"], "s", ["F"]).first().asDict() == {
        "g": "g", "F_x": 1, "F_y": 2.0, "other_x": 8, "other_y": 10.0}
    assert pivot_sums(df, ["g"], "s", ["F"], ["x"]).columns == ["g", "F_x", "other_x"]
