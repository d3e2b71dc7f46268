"""Readers and writers with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.schemas import CHANGES_SCHEMA, INITIAL_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, read by the names in it, with its times in UTC.

    The columns of the schema may stand in any order and among others; a missing one is an
    error, and so is a file whose header differs from that of the first one.  A row that does not
    fit fails the job, also if only other columns of it are used: every row is
    parsed as a whole.
    """
    names = spark.read.option("header", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    known = {f.name: f for f in schema.fields}
    found = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": False, "timeZone": "UTC"}
    rows = spark.read.schema(found).options(**options).csv(path)
    # Always true, but it needs all columns, so none of them goes unparsed.
    whole = rows.where(F.length(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in names])) >= 0)
    return whole.select(*[f.name for f in schema.fields])


def read_licenses(spark: SparkSession, initial_path: str, changes_path: str) -> tuple[DataFrame, DataFrame]:
    """Both input tables from CSV, with dates parsed."""
    return read_csv(spark, initial_path, INITIAL_SCHEMA), read_csv(spark, changes_path, CHANGES_SCHEMA)


def read_csv_utc(spark: SparkSession, path: str, schema: T.StructType, event_column: str) -> DataFrame:
    """CSV whose event column is read as a timestamp; text without an offset is UTC."""
    fields = [
        T.StructField(f.name, T.TimestampType() if f.name == event_column else f.dataType) for f in schema.fields
    ]
    return read_csv(spark, path, T.StructType(fields))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, name: str, date_column: str, path: str | None = None) -> None:
    """Replace a catalog table, its date column cast to a date; at ``path`` if given, else in
    the warehouse."""
    writer = df.withColumn(date_column, F.col(date_column).cast("date")).write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def has_min_rows(df: DataFrame, n: int) -> DataFrame:
    """One row: does ``df`` have at least ``n`` rows?  Counts no further than ``n``."""
    return df.limit(n).agg((F.count("*") >= n).alias("has_min_rows"))


def require_min_rows(df: DataFrame, n: int) -> None:
    if not has_min_rows(df, n).first()[0]:
        raise ValueError(f"expected at least {n} rows")


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table, or an empty frame of that schema if there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def set_times(spark: SparkSession, folder: str, seconds: int) -> None:
    """Gives the files of a folder that are newer than ``seconds`` that time (file streams
    take files in the order of their times)."""
    fs, target = _hadoop_path(spark, folder)
    for status in fs.listStatus(target):
        if status.getModificationTime() > seconds * 1000:
            fs.setTimes(status.getPath(), seconds * 1000, -1)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder, from the file system."""
    fs, target = _hadoop_path(spark, folder)
    return fs.getContentSummary(target).getLength()
