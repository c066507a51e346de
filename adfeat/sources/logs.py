"""Hourly and daily log partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat.functions.timing import shifted_partition

# Directory layouts of the raw logs.
PARTITION_LAYOUT = "datepart=%Y%m%d/hour=%H"
PATH_LAYOUT = "%Y/%m/%d/%H"


def read_hour_lines(spark: SparkSession, root: str, out_hour: str, shift_hours: int = 8, layout: str = PARTITION_LAYOUT) -> DataFrame:
    """Raw lines (column ``value``) of the log hour that feeds output hour ``out_hour``."""
    return spark.read.text(f"{root}/{shifted_partition(out_hour, shift_hours, layout)}")


def read_day_json(spark: SparkSession, root: str, day: str, schema: str) -> DataFrame:
    """JSON lines of all hours of a day; the schema is given, so no inference pass over the data."""
    return spark.read.schema(schema).json(f"{root}/dt={day}/hour=*")


def read_hour_table(spark: SparkSession, root: str, hour: str, **partitions: str) -> DataFrame:
    """One hour of a Parquet log partitioned by ``dt`` and ``hour`` (and more, e.g. ``flag``).

    Only that directory is listed; the partition columns stay available."""
    levels = {"dt": hour[:8], "hour": hour[8:], **partitions}
    return spark.read.option("basePath", root).parquet("/".join([root, *[f"{k}={v}" for k, v in levels.items()]]))


def scan_table(spark: SparkSession, name: str, day: str | None = None) -> DataFrame:
    """Warehouse table, restricted to partition ``dt`` if a day is given."""
    df = spark.table(name)
    return df if day is None else df.where(F.col("dt") == F.lit(day).cast(df.schema["dt"].dataType))


def partition_values(spark: SparkSession, root: str, column: str = "hour") -> DataFrame:
    """Partition values that exist under ``root``, from a listing of the files; none is opened."""
    return spark.read.format("binaryFile").load(root).select(F.col(column).cast("string").alias(column)).distinct()


def latest_snapshot(df: DataFrame, column: str = "dt", values: DataFrame | None = None) -> DataFrame:
    """Rows of the greatest partition value; the value is a scalar subquery, so it prunes partitions.

    ``values`` (:func:`partition_values`) spares a pass over ``df``."""
    return df.where(F.col(column) == (df if values is None else values).agg(F.max(column)).scalar())


def last_partitions(df: DataFrame, n: int = 24, column: str = "hour", values: DataFrame | None = None) -> DataFrame:
    """Rows of the ``n`` greatest partition values that exist (gaps are not counted).

    ``values`` (:func:`partition_values`) spares a pass over ``df``; text files would have to be read for it."""
    source = df if values is None else values
    newest = source.where(F.col(column).isNotNull()).select(column).distinct().orderBy(F.col(column).desc()).limit(n)
    return df.where(F.col(column) >= newest.agg(F.min(column)).scalar())
