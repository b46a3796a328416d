"""Bounded execution of streaming queries: available-now trigger, timeout, stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corvid.session import scratch_path
from corvid.streaming.modes import check_output_mode, plan_kind
from corvid.streaming.sinks import batch_folders
from corvid.streaming.tables import SnapshotTable, UpsertTable


def trigger_kwargs(kind: str = "available_now", interval: str | None = None) -> dict:
    """``default`` (as fast as possible), ``processing_time`` (fixed interval),
    ``available_now`` (all data, then stop; replaces ``once``), ``continuous``."""
    if kind == "default":
        return {}
    if kind == "processing_time":
        return {"processingTime": interval or "10 seconds"}
    if kind in ("available_now", "once"):
        return {"availableNow": True}
    if kind == "continuous":
        return {"continuous": interval or "1 second"}
    raise ValueError(kind)


def start(df: DataFrame, mode: str, checkpoint: str, fmt: str | None = None, path: str | None = None,
          foreach_batch: Callable | None = None, foreach=None, name: str | None = None, trigger: dict | None = None,
          partition_by: list[str] | None = None, options: dict | None = None) -> StreamingQuery:
    """Start a streaming query in ``df``'s session (``sessions.stream_session`` gives one of its own).
    An output mode that the analysed plan doesn't allow is refused before anything runs."""
    check_output_mode(plan_kind(df), mode)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif foreach is not None:
        w = w.foreach(foreach)
    elif fmt:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.trigger(**(trigger or trigger_kwargs())).start()


def await_done(q: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an available-now query, without a limit unless one is given; stop it on
    timeout and surface its error."""
    try:
        finished = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
        if timeout_s is not None and not finished:
            raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def run_to_table(spark: SparkSession, df: DataFrame, mode: str = "append", name: str = "stream",
                 fmt: str = "parquet", partition_by: list[str] | None = None, timeout_s: int | None = None,
                 checkpoint: str | None = None, path: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Run ``df`` to completion with an available-now trigger and return the sink as a batch
    DataFrame of ``spark``. Append mode writes files directly; complete mode replaces a
    ``SnapshotTable`` each batch; update mode changes an ``UpsertTable`` by ``keys``."""
    base = scratch_path(spark, name)
    checkpoint = checkpoint or f"{base}/_checkpoint"
    path = path or f"{base}/out"
    if mode == "append":
        await_done(start(df, mode, checkpoint, fmt=fmt, path=path, partition_by=partition_by), timeout_s)
        return spark.read.format(fmt).load(path)
    if mode == "complete":
        table = SnapshotTable(spark, path, fmt)
    elif mode == "update" and keys:
        table = UpsertTable(spark, path, keys)
    else:
        raise ValueError(f"mode {mode!r} with keys {keys}")
    await_done(start(df, mode, checkpoint, foreach_batch=table.write), timeout_s)
    return table.read(spark)


def status(q: StreamingQuery) -> dict:
    """Name, activity and last progress of a query handle."""
    return {"name": q.name, "id": str(q.id), "active": q.isActive, "status": q.status,
            "last_progress": q.lastProgress}
