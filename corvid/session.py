"""Session construction and shared scratch storage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings this library is designed around. AQE re-plans joins, coalesces small shuffle
# partitions and splits skewed sort-merge join partitions at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "corvid", extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and local runs; on a cluster pass ``master=None``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is read as is. Only when it is
    unset (local tests) is a private folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_rdd_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master
        if not re.match(r"local(\[[^,]*\])?$", master):
            raise ValueError(f"spark.checkpoint.dir is unset: on {master} it must name storage that all executors share")
        configured = tempfile.mkdtemp(prefix="corvid-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def _is_rdd_subdir(path: str) -> bool:
    # SparkContext appends a random UUID folder below the configured directory.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch folders of the scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory.

    Used for round-trip writes, stream checkpoints and materialised intermediates, so
    every executor (and a retried task on another host) sees the same files. It stays until the
    ``scratch_scope`` it was made in ends, or else until the checkpoint directory is cleaned.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/corvid-{name}-{uuid.uuid4().hex[:12]}"
    held = _SCOPE.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete on leaving what operators called inside have stored: a result is lazy and may read
    it, so write or collect the result inside. Scopes nest; each thread has its own."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        held = _SCOPE.get()
        _SCOPE.reset(token)
        for path in held:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared scratch storage and read it back: all branches of a later
    plan see the same rows, partition numbers and positions included."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete the files of materialised frames, once all that read them is itself stored."""
    for df in stored:
        _delete(df.sparkSession, df.scratch)
