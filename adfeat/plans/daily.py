"""Daily jobs: counter and profile snapshots, ad information, published user entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat.config import MAIN, SmoothingRules, Variant
from adfeat.operators import counters, profile, refresh
from adfeat.sinks import export, publish


def build_ad_counters(accu: DataFrame, root: str, day: str, variant: Variant = MAIN) -> None:
    export.write_snapshot(counters.ad_counters(accu, variant), root, day, by_set=True)


def build_user_counters(accu: DataFrame, root: str, day: str, variant: Variant = MAIN) -> None:
    export.write_snapshot(counters.user_counters(accu, variant), root, day)


def build_user_profiles(base: DataFrame, behaviour: DataFrame | None, allowed_apps: DataFrame | None, root: str, day: str, variant: Variant = MAIN) -> None:
    rows = profile.user_profiles(base, behaviour if variant.behaviour else None, allowed_apps)
    export.write_snapshot(rows, root, day)


def build_ad_info(apps: DataFrame, creatives: DataFrame, campaigns: DataFrame, root: str, day: str, as_of: dt.datetime) -> None:
    export.write_snapshot(profile.ad_info(profile.package_categories(apps), creatives, campaigns, as_of), root, day)


def merge_counters(spark: SparkSession, day_snapshot: DataFrame, hourly: DataFrame, root: str, day: str, rules: SmoothingRules = SmoothingRules()) -> None:
    """Day and hourly counters of names and categories, smoothed."""
    export.write_snapshot(refresh.merge_smooth(day_snapshot, hourly, rules), root, day)


def publish_merged(day_snapshot: DataFrame, hourly: DataFrame, root: str, rules: SmoothingRules = SmoothingRules(), variant: Variant = MAIN) -> tuple[int, int]:
    """Publish smoothed counters as a table (``counters``) and in both document shapes (``documents``), each once it is checked.

    The documents are made of the published table; if that is refused, neither is replaced."""

    def bad_counts(rows: DataFrame) -> DataFrame:
        return export.invalid_counters(rows.withColumn("window_tag", F.lit("30d")))

    def no_document(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("counter_key").isNull() | F.col("nested").isNull() | F.col("flat").isNull())

    spark = day_snapshot.sparkSession
    merged = refresh.merge_smooth(day_snapshot, hourly, rules)
    table = publish.publish(merged, f"{root}/counters", bad_counts)
    stored = publish.read_published(spark, f"{root}/counters", merged.schema, table)
    return table, publish.publish(export.merged_views(stored, variant), f"{root}/documents", no_document)


def publish_users(user_counters: DataFrame, profiles: DataFrame, root: str, day: str, published_at: int, variant: Variant = MAIN) -> None:
    """Key-value entries of counters and profiles, ready for :func:`adfeat.sinks.export.publish_entries`."""
    export.write_snapshot(export.user_counter_entries(user_counters, published_at, variant), f"{root}/user_counter", day)
    export.write_snapshot(export.user_profile_entries(profiles, published_at), f"{root}/user_profile", day)
