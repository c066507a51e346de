"""User profiles and ad information."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from adfeat.functions.keys import ascii_or_empty
from adfeat.functions.timing import epoch_seconds
from adfeat.schemas import PROFILE_BASE

# Behaviour types and the profile list each one fills.
BEHAVIOUR_SLOTS = {
    "app_install": "installAppList",
    "app_use": "useAppList",
    "ad_app_click": "clickAdAppList",
    "ad_app_install": "installAdAppList",
}
RESTRICTED = ("app_install", "app_use")


def user_profiles(
    base: DataFrame,
    behaviour: DataFrame | None = None,
    allowed_apps: DataFrame | None = None,
    ascii_only: bool = False,
) -> DataFrame:
    """``(user_id, userBase, userBehavior)`` for every user of either input.

    ``base`` has ``user_id`` and the five attributes, ``behaviour`` has ``(user_id, action_type,
    app_list)``. The install and use lists are restricted to ``allowed_apps`` (column ``app``).
    Several rows for the same slot: the greatest one wins, so reruns agree. A part without rows is null.

    One list wins per user and type; its apps are then exploded, the restricted ones semi joined with
    the allow-list (broadcast only if Spark finds it small), and gathered again with the base rows in
    one aggregation per user. An extra row per list keeps lists that end up empty.
    """
    attrs = []
    for c in PROFILE_BASE:
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        attrs.append((ascii_or_empty(v) if ascii_only and c in ("province", "city") else v).alias(c))
    rows = base.select("user_id", F.struct(*attrs).alias("userBase"))
    if behaviour is None:
        slots = "struct<" + ",".join(f"{s}:array<string>" for s in BEHAVIOUR_SLOTS.values()) + ">"
        return rows.groupBy("user_id").agg(F.max("userBase").alias("userBase")).withColumn("userBehavior", F.lit(None).cast(slots))

    none = F.array().cast("array<string>")
    lists = (
        behaviour.where(F.col("action_type").isin(*BEHAVIOUR_SLOTS))
        .groupBy("user_id", "action_type")
        .agg(F.max(F.array_sort(F.array_distinct(F.coalesce("app_list", none)))).alias("l"))
    )
    apps = lists.select("user_id", "action_type", F.explode(F.array_append("l", F.lit(None).cast("string"))).alias("app"))
    if allowed_apps is not None:
        # naming the exploded app keeps this filter above the aggregation, so both branches read one shuffle
        checked = F.coalesce(F.when(F.col("app").isNotNull(), F.col("action_type")).isin(*RESTRICTED), F.lit(False))
        apps = apps.where(~checked).unionByName(apps.where(checked).join(allowed_apps.select("app"), "app", "left_semi"))
    of_type = {s: F.col("action_type") == t for t, s in BEHAVIOUR_SLOTS.items()}
    users = rows.unionByName(apps, allowMissingColumns=True).groupBy("user_id").agg(
        F.max("userBase").alias("userBase"),
        *[F.collect_set(F.when(is_type, F.col("app"))).alias(s) for s, is_type in of_type.items()],
        *[F.max(is_type).alias(f"has_{s}") for s, is_type in of_type.items()],
    )
    behaviours = F.struct(*[F.when(F.col(f"has_{s}"), F.array_sort(s)).alias(s) for s in of_type])
    any_list = F.coalesce(*[F.col(f"has_{s}") for s in of_type]).isNotNull()
    return users.select("user_id", "userBase", F.when(any_list, behaviours).alias("userBehavior"))


def package_categories(apps: DataFrame) -> DataFrame:
    """One category per package; the greatest wins if a package has several."""
    return apps.groupBy("package_name").agg(F.max("category").alias("category"))


def recent_creatives(creatives: DataFrame, as_of: dt.datetime, days: int = 4) -> DataFrame:
    """Creatives created less than ``days`` before ``as_of``; the bound is a constant and can be pushed to the source."""
    # as text, or the session time zone would shift it
    since = F.lit((as_of - dt.timedelta(days=days)).isoformat(sep=" ")).cast("timestamp_ntz")
    return creatives.where(F.col("create_time") > since)


def capped_campaigns(campaigns: DataFrame) -> DataFrame:
    """Campaigns with a positive daily cap."""
    return campaigns.where(F.col("day_max") > 0)


def ad_info(categories: DataFrame, creatives: DataFrame, campaigns: DataFrame, as_of: dt.datetime) -> DataFrame:
    """``(info_key, category, creative_create_time, day_attr_install_cap)``, one row per key.

    Packages, then recent creatives, then capped campaigns; for the same key the later source
    replaces the earlier entry as a whole.
    """
    null = F.lit(None)
    layers = [
        categories.select(F.col("package_name").alias("info_key"), F.lit(0).alias("_layer"), "category",
                          null.cast("bigint").alias("creative_create_time"), null.cast("bigint").alias("day_attr_install_cap")),
        recent_creatives(creatives, as_of).select(
            F.concat(F.lit("c_id#"), F.col("id").cast("string")), F.lit(1), null.cast("string"),
            epoch_seconds("create_time"), null.cast("bigint")),
        capped_campaigns(campaigns).select(
            F.concat(F.lit("ad_id#"), F.col("id").cast("string")), F.lit(2), null.cast("string"),
            null.cast("bigint"), F.col("day_max").cast("bigint")),
    ]
    entries = layers[0].union(layers[1]).union(layers[2])
    fields = ("category", "creative_create_time", "day_attr_install_cap")
    return entries.groupBy("info_key").agg(F.max(F.struct("_layer", *fields)).alias("e")).select(
        "info_key", *[F.col(f"e.{f}").alias(f) for f in fields]
    )
