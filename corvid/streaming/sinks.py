"""Streaming sinks (STR-23..28); those that replace or change a table are in ``tables``, the sink of
single rows is in ``rows``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def kafka_sink_options(bootstrap_servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "checkpointLocation": checkpoint}


def encode_record(df: DataFrame, key: str, value_cols: list[str] | None = None, value: str | None = None) -> DataFrame:
    """``key``/``value`` string columns for a record sink: the value is one column cast to
    text or a JSON object of several columns."""
    if value is not None:
        v = F.col(value).cast("string")
    else:
        v = F.to_json(F.struct(*[F.col(c) for c in value_cols or []]))
    return df.select(F.col(key).cast("string").alias("key"), v.alias("value"))


def batch_folders(path: str, fmt: str = "parquet"):
    """``foreachBatch`` writer keeping every batch in its own folder ``batch_id=N``;
    a retried batch overwrites only its own folder, so the sink is exactly-once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def read_latest(spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet") -> DataFrame:
    """Final table of an update-mode stream written by ``batch_folders``: per key, the row
    from the newest batch (a max_by aggregate, so no key is gathered whole)."""
    df = spark.read.format(fmt).load(path)
    cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("batch_id")).alias("_r")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col("_r")[c].alias(c) for c in cols])
