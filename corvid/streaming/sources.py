"""Streaming sources (STR-01..05).

File sources take a declared schema (streams never infer). Kafka and socket readers are
builders: their option maps are what a cluster job passes; the transformations downstream
take a DataFrame with Kafka's ``key, value, timestamp`` shape, so a file replay of the
same columns is a drop-in for tests.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corvid.streaming.storage import Files

FILE_OPTIONS = ("maxFilesPerTrigger", "latestFirst", "fileNameOnly", "maxFileAge", "cleanSource",
                "sourceArchiveDir", "header", "sep", "mode", "timestampFormat", "timestampNTZFormat")

#: Input, as it is stored (columnar and compressed), that goes to one replayed file.
FILE_BYTES = 8 << 20
#: Size estimates from here on are Spark's stand-in for an unknown size, or a product of several.
NO_ESTIMATE = 1 << 60


def file_stream(spark: SparkSession, path: str, fmt: str, schema: StructType | str,
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """``readStream.format(fmt).schema(schema)`` with file-source options passed through."""
    unknown = set(options) - set(FILE_OPTIONS)
    if unknown:
        raise ValueError(f"unknown file source options: {sorted(unknown)}")
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def archiving_stream(spark: SparkSession, path: str, fmt: str, schema: StructType | str, archive: str,
                     max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """A file stream whose files move below ``archive`` after the batch that read them is committed
    (``cleanSource``). Spark moves them from a thread of its own, one batch later, so the files of
    the last batches may stay; ``read_archived`` reads both."""
    return file_stream(spark, path, fmt, schema, max_files_per_trigger, cleanSource="archive", sourceArchiveDir=archive,
                       **options)


def read_archived(spark: SparkSession, path: str, fmt: str, schema: StructType | str, archive: str) -> DataFrame:
    """What an ``archiving_stream`` has read: the files it has moved, and those still in place."""
    reader = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    kept = reader.load(path)
    return kept.unionByName(reader.load(archive)) if Files(spark, archive).exists("") else kept


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = True, **extra) -> dict[str, str]:
    if starting_offsets not in ("earliest", "latest") and not starting_offsets.startswith("{"):
        raise ValueError("startingOffsets must be earliest, latest or a JSON offset map")
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**options).load()


def socket_options(host: str, port: int, include_timestamp: bool = False) -> dict[str, str]:
    return {"host": host, "port": str(port), "includeTimestamp": str(include_timestamp).lower()}


def socket_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Text lines from a TCP socket (testing only: not fault tolerant)."""
    return spark.readStream.format("socket").options(**options).load()


def rate_stream(spark: SparkSession, rows_per_second: int = 10, num_partitions: int | None = None,
                per_micro_batch: int | None = None) -> DataFrame:
    """``rate`` (or ``rate-micro-batch`` when ``per_micro_batch``) source: (timestamp, value)."""
    if per_micro_batch:
        r = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per_micro_batch)
    else:
        r = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        r = r.option("numPartitions", num_partitions)
    return r.load()


def replay_files(df: DataFrame, path: str, time_col: str, n_files: int, fmt: str = "parquet",
                 extra: list[DataFrame] | None = None, columns: list[str] | None = None) -> str:
    """Write a batch table as ``n_files`` files in order of time and about equal in rows, by one job; a
    file source with ``maxFilesPerTrigger`` replays them in that order, as their modification times
    are set a second apart. ``extra`` frames are appended afterwards as further files (late data). Rows
    without a time are in the first file; few rows make fewer files. ``columns`` are those written
    (all by default). Returns a glob path over the files' folders."""
    return _replay(df, path, time_col, n_files, 1, fmt, extra, columns)[0]


def replay_batches(df: DataFrame, path: str, time_col: str, n_batches: int, fmt: str = "parquet",
                   extra: list[DataFrame] | None = None, columns: list[str] | None = None,
                   inputs: list[DataFrame] | None = None) -> tuple[str, int]:
    """``replay_files`` for ``n_batches`` batches of so many files each as the input needs, since a file
    is written by one task: the path and the files of a batch, to be given as ``maxFilesPerTrigger``.
    ``inputs`` are the tables ``df`` is made of, if it isn't one itself (a join's size estimate is far too
    large). Without an estimate a batch has a file per core. Rows without a time come first."""
    stored = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in inputs or [df]]
    if max(stored) < NO_ESTIMATE:
        per_batch = max(1, -(-sum(stored) // (n_batches * FILE_BYTES)))
    else:
        per_batch = df.sparkSession.sparkContext.defaultParallelism
    return _replay(df, path, time_col, n_batches, per_batch, fmt, extra, columns)


def _replay(df, path, time_col, n_batches, per_batch, fmt, extra, columns) -> tuple[str, int]:
    spark = df.sparkSession
    # rows of one time that are more than a file's go to several files
    ties = [F.xxhash64(*df.columns)] if per_batch > 1 else []
    ranged = df.repartitionByRange(n_batches * per_batch, F.col(time_col).asc_nulls_first(), *ties)
    ranged.select(*columns or df.columns).write.mode("overwrite").format(fmt).save(f"{path}/b")
    files = Files(spark, path)
    parts = [n for n in files.names("b") if n.startswith("part-")]
    end = int(time.time() * 1000) - 1000
    for i, part in enumerate(parts):
        files.set_time(f"b/{part}", end - 1000 * (len(parts) - i))
    for j, late in enumerate(extra or []):
        late.write.mode("overwrite").format(fmt).save(f"{path}/x{j:03d}")
    return f"{path}/[bx]*", max(1, -(-len(parts) // n_batches))
