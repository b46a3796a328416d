"""File sources and sinks (SRC, SNK): CSV/TSV/JSON/Parquet/text readers and writers.

Readers always take an explicit schema when one is known (no inference pass over the
data); parsing problems follow Spark's ``mode`` option. Writers go to shared storage
(see ``corvid.session.scratch_path``), never to a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite",
              date_format: str | None = None, compression: str | None = None) -> str:
    w = (df.write.mode(mode).option("header", header).option("sep", sep)
         .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT))
    if date_format:
        w = w.option("dateFormat", date_format)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, header: bool = True, schema: StructType | str | None = None,
             infer: bool = False, sep: str = ",", mode: str = "PERMISSIVE", date_format: str | None = None,
             names: list[str] | None = None) -> DataFrame:
    """CSV reader. Without schema or inference every column is a string; ``names``
    renames positional columns of a headerless file (``toDF``)."""
    r = (spark.read.option("header", header).option("sep", sep).option("mode", mode)
         .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT))
    if date_format:
        r = r.option("dateFormat", date_format)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    return df.toDF(*names) if names else df


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
    return (r.schema(schema) if schema is not None else r).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_text(df: DataFrame, column: str, path: str, compression: str | None = None,
               partition_by: list[str] | None = None, max_records_per_file: int | None = None) -> str:
    """One line per row (``saveAsTextFile``), optionally gzip/bzip2 compressed."""
    w = df.select(F.col(column).cast("string").alias("value"), *(partition_by or [])).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as one ``value`` row per line (``textFile``)."""
    return spark.read.text(path)


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``(path, content)`` (``wholeTextFiles``). Bound file sizes when
    writing (``maxRecordsPerFile``): a file is read by one task into one row."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"),
                                                        F.col("value").alias("content"))


def save_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Catalog table stored as Parquet at an explicit shared location; returns ``spark.table``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def number_range(df: DataFrame, col: str, out: str = "number") -> DataFrame:
    """The whole numbers from the smallest to the largest value of ``col`` (``range``), made in the
    cluster's partitions; none if there is no value."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    return df.sparkSession.range(lo or 0, 0 if lo is None else hi + 1).toDF(out)


def schema_profile(df: DataFrame) -> DataFrame:
    """``printSchema`` plus a non-NULL count per column: (column, type, nullable, non_null),
    computed in one aggregate pass and unpivoted with ``stack``."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    args = []
    for i, f in enumerate(fields):
        args += [F.lit(f.name), F.lit(f.dataType.simpleString()), F.lit(f.nullable), F.col(f"_c{i}")]
    return counts.select(F.stack(F.lit(len(fields)), *args).alias("column", "type", "nullable", "non_null"))


def schema_rows(df: DataFrame) -> DataFrame:
    """``printSchema`` as a DataFrame of (column, type, nullable) — metadata only, no data read."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def from_local(spark: SparkSession, rows: list, schema: StructType | str, num_partitions: int | None = None) -> DataFrame:
    """Small driver-side collection as a DataFrame (``parallelize(xs, n)``); for test
    fixtures and lookup lists only, never for data that grows."""
    df = spark.createDataFrame(rows, schema)
    return df.repartition(num_partitions) if num_partitions else df


def to_pandas_guarded(df: DataFrame, max_rows: int = 100_000):
    """``toPandas()`` for small results only: fails instead of pulling a large frame into the
    driver (fetches at most ``max_rows + 1`` rows)."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to storage instead")
    return head


def for_each_partition(df: DataFrame, fn) -> None:
    """Run a side-effecting function once per partition (``foreachPartition``) on the
    executors, e.g. to push rows to an external system in batches."""
    df.foreachPartition(fn)
