"""Progress of streaming queries as data (STR-29, STR-32): a listener that stores one row per batch."""

from __future__ import annotations

import json
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from corvid.streaming.storage import Files

PROGRESS = ("name STRING, query_id STRING, run_id STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT, "
            "duration_ms BIGINT, state_rows BIGINT, state_removed BIGINT, watermark STRING")


class ProgressLog(StreamingQueryListener):
    """Writes each batch's progress to a file of its own below ``path``, named by run and batch, so
    one that is reported again replaces itself. Nothing is held in memory."""

    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = Files(spark, path), path
        self.ended: dict[str, threading.Event] = {}
        self.failures: dict[str, str] = {}

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"name": p.name, "query_id": str(p.id), "run_id": str(p.runId), "batch_id": p.batchId, "at": p.timestamp,
               "input_rows": p.numInputRows, "duration_ms": p.batchDuration,
               "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
               "state_removed": sum(s.numRowsRemoved for s in p.stateOperators),
               "watermark": p.eventTime.get("watermark")}
        self.files.write(f"{p.runId}-{p.batchId:012d}.json", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures[str(event.runId)] = event.exception
        self._end(event.runId).set()

    def await_end(self, run_id: str, timeout_s: float = 60) -> None:
        """Wait until all progress of a run that has ended is stored."""
        if not self._end(run_id).wait(timeout_s):
            raise TimeoutError(f"no end of run {run_id} was reported in {timeout_s} s")


@contextmanager
def logged(spark: SparkSession, path: str):
    """A ``ProgressLog`` of the queries started in ``spark`` meanwhile."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path)
