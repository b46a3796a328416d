"""Property tests: the skew-safe operators agree with Spark's own operators on random data
(random keys with heavy repetition, NULLs and ties)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.operators import agg, joins, windows

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5),
                          st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@SETTINGS
@given(ROWS)
def test_running_sum_and_rank_match_window(spark, rows):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(rows)],
                               "k string, o int, v int, id int").repartition(3)
    got = windows.running(df, ["k"], ["o", "id"], {"s": ("sum", "v"), "m": ("max", "v")}, max_group_rows=0)
    got = windows.ranks(got, ["k"], ["o desc"], max_group_rows=0)
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    wr = Window.partitionBy("k").orderBy(F.col("o").desc())
    want = df.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                     F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"))
    cols = ["id", "s", "m", "rank", "dense_rank"]
    assert _sorted(got.select(*cols).collect()) == _sorted(want.select(*cols).collect())


@SETTINGS
@given(ROWS, st.sampled_from(["left", "right", "full"]))
def test_outer_join_matches_spark(spark, rows, how):
    left = spark.createDataFrame([(k, o) for k, o, _ in rows], "ka string, o int")
    right = spark.createDataFrame([(k, v) for k, _, v in rows[::2]], "kb string, v int")
    got = joins.outer_join(left, right, "ka", "kb", how).select("ka", "o", "kb", "v").collect()
    want = left.join(right, left.ka == right.kb, how).select("ka", "o", "kb", "v").collect()
    assert _sorted(got) == _sorted(want)


@SETTINGS
@given(ROWS, st.integers(1, 4))
def test_bounded_collect_preserves_every_value(spark, rows, max_items):
    df = spark.createDataFrame([(k, o) for k, o, _ in rows], "k string, o int")
    out = agg.collect_bounded(df, ["k"], "o", max_items=max_items).collect()
    got = sorted(((r.k, v) for r in out for v in r["values"]), key=str)
    assert got == sorted(((k, o) for k, o, _ in rows), key=str)
    assert all(len(r["values"]) == r.n for r in out)
