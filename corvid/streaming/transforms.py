"""Streaming transformations (STR-06..21, 33..38).

They are ordinary DataFrame functions and work unchanged on batch frames, which is how
the tests compare a stream against the batch result. Windowed aggregations declare a
watermark so state is evicted and append mode can emit closed windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import tokens


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Event-time column as TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def words(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    return lines.select(*(keep or []), F.explode(tokens(col)).alias("word"))


def word_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    return words(lines, col).groupBy("word").agg(F.count("*").alias("n"))


def windowed_counts(df: DataFrame, ts: str, size: str, keys: list[str], slide: str | None = None,
                    watermark: str | None = None) -> DataFrame:
    """Tumbling (or sliding with ``slide``) window counts per key."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w.alias("window"), *keys).agg(F.count("*").alias("n"))


def session_counts(df: DataFrame, ts: str, gap: str, keys: list[str], watermark: str) -> DataFrame:
    return (df.withWatermark(ts, watermark)
            .groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(F.count("*").alias("n")))


def buy_sell_windows(df: DataFrame, ts: str, size: str, type_col: str, amount: str, buy: str, sell: str,
                     watermark: str | None = None) -> DataFrame:
    """Per window: sum of buy amounts and of sell amounts (CASE WHEN split)."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    split = df.select(ts, F.when(F.col(type_col) == buy, F.col(amount)).otherwise(0).alias("buys"),
                      F.when(F.col(type_col) == sell, F.col(amount)).otherwise(0).alias("sells"))
    return split.groupBy(F.window(ts, size).alias("window")).agg(F.sum("buys").alias("buys"),
                                                                 F.sum("sells").alias("sells"))


def window_bounds(df: DataFrame, col: str = "window", ntz: bool = True) -> DataFrame:
    """``window.start``/``window.end`` as plain columns (wall-clock TIMESTAMP_NTZ by default)."""
    start, end = F.col(f"{col}.start"), F.col(f"{col}.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [c for c in df.columns if c != col]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


def window_averages(df: DataFrame, ts: str, size: str, key: str, values: dict[str, Column], watermark: str) -> DataFrame:
    return (df.withWatermark(ts, watermark).groupBy(F.window(ts, size).alias("window"), key)
            .agg(*[F.avg(v).alias(n) for n, v in values.items()]))


def avg_of_averages(df: DataFrame, ts: str, size: str, entity: str, value: str, watermark: str) -> DataFrame:
    """Chained aggregation: mean per (window, entity), then mean of those means per window."""
    per_entity = (df.withWatermark(ts, watermark).groupBy(F.window(ts, size).alias("window"), entity)
                  .agg(F.avg(value).alias("entity_avg")))
    return per_entity.groupBy("window").agg(F.avg("entity_avg").alias("avg_of_avg"),
                                            F.count("*").alias("n_entities"))


def join_on_window(left: DataFrame, right: DataFrame) -> DataFrame:
    """Stream-stream inner join of two watermarked windowed aggregates on their window."""
    return left.join(right, "window", "inner")


def order_lines(records: DataFrame, schema: str, value_col: str = "value") -> DataFrame:
    """Order records (JSON) to one row per line, with the order's own fields."""
    order = F.from_json(F.col(value_col).cast("string"), schema)
    lines = records.withColumn("r", order).select("r.o_orderkey", "r.o_custkey", "r.nation", F.explode("r.lines").alias("l"))
    return lines.select("o_orderkey", "o_custkey", "nation", "l.*")


def reward_records(records: DataFrame, schema: str, rate: float = 0.2, value_col: str = "value") -> DataFrame:
    """Reward notices for a record sink: one per order, keyed by it; the value is a JSON
    struct of the customer, the order's total and the points earned on it. Blocks that
    continue an order give none."""
    order = F.from_json(F.col(value_col).cast("string"), schema)
    first = records.withColumn("r", order).where("r.block = 0")
    notice = F.struct(F.col("r.o_custkey").alias("customer"), F.col("r.o_totalprice").alias("spent"),
                      (F.col("r.o_totalprice") * F.lit(rate)).alias("points"))
    return first.select(F.col("r.o_orderkey").cast("string").alias("key"), F.to_json(notice).alias("value"))


def enrich_static(stream: DataFrame, static: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Stream-static join (inner or left outer with the stream on the left)."""
    return stream.join(static, on, how)
