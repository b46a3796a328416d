"""Rows through an external command."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvid.operators import pipe

ODD = [(1, "plain"), (2, "two\nlines\r\nand\ttab"), (3, "back\\slash \\n \\\\N \\"), (4, ""), (5, None), (6, "\\N"),
       (7, "\x00\n\x00\\"), (8, "é漢\U0001f600"), (9, "long " * 50_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "id long, text string")


def test_escape_round_trip(odd):
    back = odd.select("id", pipe.unescaped(F.coalesce(pipe.escaped(F.col("text")), F.lit("\\N"))).alias("text"))
    assert sorted(map(tuple, back.collect())) == ODD


def test_every_row_is_one_line(odd):
    lines = pipe.pipe(odd.repartition(3), ["cat"]).collect()
    assert len(lines) == len(ODD) and all("\n" not in r.line and r.line.count("\t") == 1 for r in lines)


def test_command_runs_once_per_partition(spark):
    counts = pipe.pipe(spark.range(0, 100_000, numPartitions=5), ["wc", "-l"]).collect()
    assert [int(r.line) for r in counts] == [20_000] * 5


def test_column_keeps_rows_together(odd):
    got = pipe.pipe_column(odd.repartition(4), ["cat"], "text", "same")
    assert got.columns == ["id", "text", "same"]
    assert all(r.text == r.same for r in got.collect())


def test_large_partition_does_not_wait_for_itself(spark):
    """More than both pipe buffers hold, through a command that holds back its output to the end."""
    df = spark.range(0, 300_000, numPartitions=2).select(F.concat(F.lit("x" * 50), F.col("id")).alias("v"))
    assert pipe.pipe(df, ["sort", "-r"], env={"LC_ALL": "C", "PATH": "/usr/bin:/bin"}).distinct().count() == 300_000
    got = pipe.pipe_column(df, ["sed", "s/x//g"], "v", "w").selectExpr("count(distinct cast(w as long)) as n")
    assert got.first().n == 300_000


def test_failing_command_fails_the_job(spark, odd):
    with pytest.raises(Exception, match="ended with code 3: no such thing"):
        pipe.pipe(odd, ["sh", "-c", "cat > /dev/null; echo no such thing >&2; exit 3"]).collect()
    with pytest.raises(Exception, match="ended with code 1"):
        pipe.pipe_column(spark.range(10), ["grep", "none"], "id", "out").collect()
    assert pipe.pipe(odd.coalesce(1), ["sh", "-c", "cat > /dev/null; echo said; exit 3"], check=False).first().line == "said"


def test_lines_lost_or_added_fail_the_job(spark):
    with pytest.raises(Exception, match="lines for the last"):
        pipe.pipe_column(spark.range(10), ["grep", "-v", "3"], "id", "out").collect()


def test_command_that_needs_no_input(spark):
    assert pipe.pipe(spark.range(0, 200_000, numPartitions=2), ["head", "-n", "1"]).count() == 2
    counts = pipe.pipe(spark.range(0, 1, numPartitions=2), ["wc", "-l"]).collect()
    assert sorted(int(r.line) for r in counts) == [0, 1]


def test_errors_of_the_rows_surface(spark):
    bad = spark.range(10).select(F.raise_error(F.lit("bad row")).cast("string").alias("v"))
    with pytest.raises(Exception, match="bad row"):
        pipe.pipe(bad, ["cat"]).collect()


@pytest.mark.parametrize("column", [False, True])
def test_long_rows_pass_in_small_pieces(spark, monkeypatch, column):
    """A batch of 10,000 long texts is held as Python objects, and given back, piece by piece."""
    through = []
    df = spark.range(1).select(F.lit("x").alias("text"))
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: through.append(f) or self.withColumn("out", F.lit("")))
    pipe.pipe_column(df, ["cat"], "text", "out") if column else pipe.pipe(df, ["cat"])
    texts = [f"{i} " + "é" * 2000 for i in range(10_000)] + ["", "long " * 500_000, "end"]
    names = ["text", "out"] if column else ["line"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)] * len(names), names=names)
    out = list(through[0](iter([batch, batch.slice(0, 0), batch.slice(10_000)])))
    assert [v for b in out for v in b.column(len(names) - 1).to_pylist()] == texts + texts[10_000:]
    assert max(b.nbytes for b in out) < 16 << 20
