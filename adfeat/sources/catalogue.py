"""Hourly tables whose partitions are registered in the session catalogue: scans ask it and list no folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

REGISTERED_AT_ONCE = 500  # partitions named in one statement


def create_hour_table(spark: SparkSession, table: str, schema: str, location: str, form: str = "parquet") -> None:
    """A table partitioned by ``dt`` and ``hour`` over ``location``; it has no partitions until they are registered."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}, dt STRING, hour STRING) USING {form} PARTITIONED BY (dt, hour) LOCATION '{location}'")


def write_hours(rows: DataFrame, root: str, form: str = "parquet", column: str = "hour", mode: str = "append") -> None:
    """``rows`` under ``dt=/hour=`` of their ``yyyyMMddHH`` hour, one file per hour and task that has some."""
    hour = F.col(column)
    parts = rows.withColumns({"_dt": F.substring(hour, 1, 8), "_hour": F.substring(hour, 9, 2)}).drop(column)
    parts = parts.withColumnsRenamed({"_dt": "dt", "_hour": "hour"})
    parts.repartition("dt", "hour").write.mode(mode).partitionBy("dt", "hour").format(form).save(root)


def hours_of(rows: DataFrame, column: str = "hour") -> list[str]:
    """The hours that occur, in order: one value per partition."""
    return sorted(r[0] for r in rows.select(column).where(F.col(column).isNotNull()).distinct().collect())


def register_hours(spark: SparkSession, table: str, hours: Iterable[str]) -> None:
    """Make written hours visible, late ones too; safe to repeat, no folder is listed."""
    named = [f"PARTITION (dt='{h[:8]}', hour='{h[8:]}')" for h in hours]
    for at in range(0, len(named), REGISTERED_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(named[at : at + REGISTERED_AT_ONCE])}")


def scan_hours(spark: SparkSession, table: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of the registered hours from ``first`` to ``last`` (``yyyyMMddHH``, both included), ``hour`` as that text.

    The bounds are on partition columns only, so the catalogue is asked for these partitions and others are not read."""
    rows, hour = spark.table(table), F.concat("dt", "hour")
    if first is not None:
        rows = rows.where((F.col("dt") >= first[:8]) & (hour >= first))
    if last is not None:
        rows = rows.where((F.col("dt") <= last[:8]) & (hour <= last))
    return rows.withColumn("hour", hour).drop("dt")
