"""A stream's sink by city and day, and slices of it (DOC-08): what a dashboard reads while the
stream goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.streaming import run


def run_weather_sink(spark: SparkSession, weather: DataFrame, path: str, checkpoint: str) -> str:
    """Write the readings of a stream (city, event_time, temperature) as Parquet in folders by city and
    day. Rows without a city or a time go to Spark's default folder."""
    out = weather.select("city", F.to_date("event_time").alias("day"), "event_time", "temperature")
    run.await_done(run.start(out, "append", checkpoint, fmt="parquet", path=path, partition_by=["city", "day"]))
    return path


def weather_slice(spark: SparkSession, path: str, city: str, start: str, end: str) -> DataFrame:
    """Readings of ``city`` from ``start`` (a date or time) up to before ``end``. Spark lists the sink by its
    own log, so a batch that is half written isn't seen; city and days pick the folders to
    read, the times the rows inside."""
    lo, hi = (F.lit(x).cast("timestamp") for x in (start, end))
    return (spark.read.parquet(path)
            .where((F.col("city") == city) & F.col("day").between(F.to_date(lo), F.to_date(hi)))
            .where((F.col("event_time") >= lo) & (F.col("event_time") < hi)))
