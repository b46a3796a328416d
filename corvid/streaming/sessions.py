"""Sessions of their own for streaming queries.

A streaming query takes its state settings from the session it is started in. Setting them on the
caller's session would change that session for every thread; a new session on the same
cluster takes the caller's settings and these.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Keyed state and windows on disk-backed stores; sessions merged in each task before their shuffle.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def stream_session(spark: SparkSession, state_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with ``spark``'s settings, ``STATE_CONF`` and ``conf``. The number of state-store
    partitions, fixed by the first run of a checkpoint, is ``state_partitions`` or the cluster's
    cores (``defaultParallelism``) rather than the batch shuffle setting. Temporary views of the two
    sessions are apart."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and key.startswith("spark.sql."):
            own.conf.set(key, value)
    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    for key, value in {**settings, **STATE_CONF, **conf}.items():
        own.conf.set(key, value)
    return own
