"""Hourly jobs: raw logs to per-ad lines, raw events to event tables, recent events into the counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from adfeat import schemas
from adfeat.functions.timing import local_day_hours
from adfeat.operators import counters, flatten, project, refresh
from adfeat.sinks import export, publish
from adfeat.sources import logs, stores

# log kind: flattening operator and directory layout of the raw log
LOG_KINDS = {
    "mixer": (flatten.flatten_mixer_log, logs.PARTITION_LAYOUT),
    "rec": (flatten.flatten_rec_log, logs.PATH_LAYOUT),
    "req_ads": (flatten.flatten_req_ads, logs.PATH_LAYOUT),
    "train_feature": (flatten.flatten_train_feature, logs.PATH_LAYOUT),
}


def flatten_log_hour(spark: SparkSession, kind: str, raw_root: str, out_root: str, hour: str, table: str | None = None) -> None:
    """Flatten one hour of a raw log into ``dt=/hour=`` JSON lines and register the partition of ``table``."""
    operator, layout = LOG_KINDS[kind]
    export.write_hour_lines(operator(logs.read_hour_lines(spark, raw_root, hour, layout=layout)), out_root, hour)
    if table:
        export.register_hour(spark, table, hour, f"{out_root}/dt={hour[:8]}/hour={hour[8:]}")


def project_imp_click_hour(spark: SparkSession, log_root: str, out_root: str, hour: str, packages) -> None:
    log = logs.read_hour_table(spark, log_root, hour)
    export.write_tsv(project.project_imp_click(log, packages), f"{out_root}/hour={hour}")


def project_install_hour(spark: SparkSession, log_root: str, out_root: str, hour: str, packages, flag: str) -> None:
    log = logs.read_hour_table(spark, log_root, hour, flag=flag)
    export.write_tsv(project.project_install(log, packages), f"{out_root}/hour={hour}")


def recent_events(spark: SparkSession, imp_click_root: str, install_root: str, excluded_package: str, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """Impressions with clicks, and installs, of the newest ``hours`` partitions of each."""

    def newest(root: str, schema: str) -> DataFrame:
        rows = stores.read_tsv(spark, root, schema + ", hour string")
        return logs.last_partitions(rows, hours, values=logs.partition_values(spark, root))

    shows, installs = newest(imp_click_root, schemas.IMP_CLICK_TSV), newest(install_root, schemas.INSTALL_TSV)
    return shows, project.exclude_package(installs, excluded_package)


def refreshed(spark: SparkSession, snapshot: DataFrame, imp_click_root: str, install_root: str, now: dt.datetime, excluded_package: str) -> DataFrame:
    """The daily ``snapshot`` brought up to date with recent events.

    Always starts from the daily snapshot, so hourly additions do not pile up."""
    shows, installs = recent_events(spark, imp_click_root, install_root, excluded_package)
    return refresh.refresh_snapshot(
        snapshot, counters.event_counters(shows, installs), counters.local_day_installs(installs, *local_day_hours(now))
    )


def publish_refresh(
    spark: SparkSession, snapshot: DataFrame, imp_click_root: str, install_root: str, root: str, now: dt.datetime, excluded_package: str
) -> int:
    """Publish the refreshed counters under ``root`` once they are written and checked (:func:`adfeat.sinks.publish.publish`)."""
    return publish.publish(refreshed(spark, snapshot, imp_click_root, install_root, now, excluded_package), root)


def refresh_counters_hour(
    spark: SparkSession,
    snapshot: DataFrame,
    imp_click_root: str,
    install_root: str,
    out_path: str,
    now: dt.datetime,
    excluded_package: str,
) -> DataFrame:
    """Write the refreshed counters to a path of their own, for readers that check themselves; returns the rows a consumer would refuse."""
    refreshed(spark, snapshot, imp_click_root, install_root, now, excluded_package).write.mode("errorifexists").parquet(out_path)
    return export.invalid_counters(spark.read.parquet(out_path))
