"""Bringing a daily counter snapshot up to date with recent events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adfeat.config import MEASURES, SmoothingRules
from adfeat.operators.counters import window_totals

KEYS = ["dim_set", "dim_key", "window_tag"]
SMOOTHED_SETS = ("ad_package_name", "ad_package_category")


def refresh_snapshot(snapshot: DataFrame, recount: DataFrame, day_installs: DataFrame | None = None) -> DataFrame:
    """Overlay a 24-hour ``recount`` (window ``1d``) on ``snapshot``.

    Per key of the recount the slot ``1d`` is replaced as a whole, ``3d`` and ``7d`` grow by it;
    ``day_installs`` (window ``Bj1d``) replaces its slot. Everything else passes through, also an
    old ``1d`` of a key that had no recent event. A union and one aggregation replace the full
    outer join, so snapshot and recount are shuffled once and combined map-side.
    """
    fresh = recount.select(
        "dim_set", "dim_key",
        F.explode(F.array(*[F.lit(w) for w in ("1d", "3d", "7d")])).alias("window_tag"), *MEASURES,
    )
    if day_installs is not None:
        fresh = fresh.unionByName(day_installs.select(*KEYS, *MEASURES))
    rows = snapshot.select(*KEYS, *MEASURES, F.lit(False).alias("_new")).unionByName(
        fresh.withColumn("_new", F.lit(True))
    )
    old, new = ~F.col("_new"), F.col("_new")
    aggs = [F.max("_new").alias("_fresh")]
    for m in MEASURES:
        aggs += [
            F.coalesce(F.sum(F.when(old, F.col(m))), F.lit(0)).alias(f"_old_{m}"),
            F.coalesce(F.sum(F.when(new, F.col(m))), F.lit(0)).alias(f"_new_{m}"),
        ]
    replaced = F.col("_fresh") & F.col("window_tag").isin("1d", "Bj1d")
    return rows.groupBy(*KEYS).agg(*aggs).select(
        *KEYS,
        *[
            F.when(replaced, F.col(f"_new_{m}")).otherwise(F.col(f"_old_{m}") + F.col(f"_new_{m}")).alias(m)
            for m in MEASURES
        ],
    )


def merge_smooth(day: DataFrame, hourly: DataFrame, rules: SmoothingRules = SmoothingRules()) -> DataFrame:
    """Sum the day's ``7d`` and the hourly ``30d`` slots of name and category keys, then smooth.

    The first rule that applies decides: a category with few impressions takes the totals of all
    categories; a name with few impressions is set to a small constant; a key without installs in
    the day snapshot gets one install per ``imps_per_install`` impressions. ``day_cvr`` is the
    capped day install rate per click, for information only.
    """
    day, hourly = (
        df.where(F.col("dim_set").isin(*SMOOTHED_SETS) & (F.col("window_tag") == w))
        for df, w in ((day, "7d"), (hourly, "30d"))
    )
    rows = day.select("dim_set", "dim_key", *MEASURES, F.lit(True).alias("_day")).unionByName(
        hourly.select("dim_set", "dim_key", *MEASURES, F.lit(False).alias("_day"))
    )
    aggs = [F.sum(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in MEASURES] + [
        F.sum(F.when(F.col("_day"), F.coalesce(F.col(m), F.lit(0))).otherwise(F.lit(0))).alias(f"_day_{m}")
        for m in ("click", "attr_install")
    ]
    merged = rows.groupBy("dim_set", "dim_key").agg(*aggs)
    totals = window_totals(day).select(F.struct("all_imp", "all_install")).scalar()  # one row
    all_imp, all_install = totals["all_imp"], totals["all_install"]
    few_category = (F.col("dim_set") == "ad_package_category") & (F.col("imp") < rules.category_min_imp)
    few_name = (F.col("dim_set") == "ad_package_name") & (F.col("imp") < rules.name_min_imp)
    estimate = F.floor(F.col("imp") / F.lit(float(rules.imps_per_install)))
    return merged.select(
        "dim_set", "dim_key",
        F.when(few_category, all_imp).when(few_name, F.lit(rules.name_floor_imp)).otherwise(F.col("imp"))
        .cast("bigint").alias("imp"),
        "click",
        F.when(few_category, all_install).when(few_name, F.col("attr_install"))
        .when(F.col("_day_attr_install") == 0, estimate).otherwise(F.col("attr_install"))
        .cast("bigint").alias("attr_install"),
        capped_rate(F.col("_day_attr_install"), F.col("_day_click")).alias("day_cvr"),
    )


def capped_rate(pos: Column, total: Column, cap: float = 0.01) -> Column:
    """``min(pos / total, cap)``, null without a total."""
    return F.least(F.try_divide(pos.cast("double"), total), F.when(total > 0, F.lit(cap)))


def wilson_lower_bound(pos: Column, total: Column, z: float = 2.0) -> Column:
    """Lower end of the Wilson score interval of ``pos`` out of ``total``; null without a total."""
    n = F.nullif(total.cast("double"), F.lit(0.0))
    k = pos.cast("double")
    zz = F.lit(z * z)
    return (k + zz / 2 - F.lit(z) * F.sqrt(k * (n - k) / n + zz / 4)) / (n + zz)
