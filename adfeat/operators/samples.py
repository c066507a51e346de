"""Training samples: label rows with the counters, profiles or logged features that belong to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from adfeat.config import MAIN, Variant
from adfeat.functions.cells import empty_cell
from adfeat.functions.jsontext import open_object
from adfeat.functions.keys import dim_text, keyed_sets
from adfeat.operators.counters import counter_cells
from adfeat.operators.skew import HOT_ROWS, chunked, counted_keys, join_hot, join_packed, key_counts, perhaps_asked, repeated

AD_DIMS = ("package_name", "pos_id", "ad_id", "ad_package_name", "ad_package_category", "c_id")
USER_AD_DIMS = ("pos_id", "ad_id", "ad_package_name", "ad_package_category", "c_id")


def check_dates(feature_date: str, label_date: str) -> None:
    """Features must be older than the labels they explain."""
    if not dt.date.fromisoformat(feature_date) < dt.date.fromisoformat(label_date):
        raise ValueError(f"feature date {feature_date} is not before label date {label_date}")


def feature_date_of(label_date: Column) -> Column:
    """Day whose counters and profiles go with labels of ``label_date``."""
    return F.date_sub(label_date, 1)


def of_label_users(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the users that labels ask for: narrow input of user counters, cut down before it is multiplied by dimension sets."""
    users = labels.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    return perhaps_asked(rows, users, ["user_id"]).join(users, "user_id", "left_semi")


def pair_days(labels: DataFrame, features: DataFrame, keys: list[str], day: str = "dt", how: str = "left") -> DataFrame:
    """Labels of any number of days, each with the features of the day before (:func:`feature_date_of`).

    ``day`` is the partition column of both, as ``yyyyMMdd`` text. The days that occur, one row each, are broadcast to the features first:
    their partitions are then pruned while the query runs, and only those of days before a label day are read. Features
    of the label day itself or later never reach a label."""
    before = F.date_format(feature_date_of(F.to_date(day, "yyyyMMdd")), "yyyyMMdd")
    # the condition holds for every day; without a comparison Spark takes a list for unselective and prunes nothing
    days = labels.select(before.alias("_before")).where(F.col("_before") >= "00000000").distinct()
    old = features.join(F.broadcast(days), F.col(day) == F.col("_before"), "left_semi").withColumnRenamed(day, "_before")
    joined = labels.withColumn("_before", before).join(old, ["_before", *keys], how)
    return joined.withColumnRenamed("_before", f"feature_{day}")


def _slots(tuples: DataFrame, counters: DataFrame, sets, owner: tuple[str, ...], variant: Variant, hot_rows: int, first: bool = False) -> DataFrame:
    """Counter cells of every dimension set for each distinct tuple: the tuple and its slot columns.

    Tuple columns are key texts named ``t_<dim>``; ``owner`` columns stand outside the key text.
    The tuples are exploded into one narrow row per set, joined once, and folded back (at most
    one row per set and tuple). Counters of keys that no tuple asks for are dropped before their
    windows are gathered; both steps share one shuffle on the key. ``first`` drops most of them before that shuffle
    (:func:`perhaps_asked`): worth it for rows not yet added up, whose keys are columns.
    """
    cols = tuples.columns
    wanted = tuples.select(*cols, F.explode(keyed_sets(sets, "t_")).alias("s")).select(*cols, "s.*")
    on = [*[f"t_{o}" for o in owner], "dim_set", "dim_key"]
    counts = key_counts(wanted, on)
    asked = counted_keys(counts).withColumnsRenamed({f"t_{o}": o for o in owner})
    key = [*owner, "dim_set", "dim_key"]
    needed = (perhaps_asked(counters, asked, key) if first else counters).join(asked, key, "left_semi")
    cells = counter_cells(needed, variant, by=owner).withColumnsRenamed({o: f"t_{o}" for o in owner})
    found = join_hot(wanted, cells, on, "inner", hot_rows, counts, chunk=None)
    folded = found.groupBy(*cols).agg(F.map_from_entries(F.collect_list(F.struct("dim_set", "cell"))).alias("m"))
    return folded.select(*cols, *[F.col("m")[s.name].alias(s.slot) for s in sets])


def assemble_samples(
    labels: DataFrame,
    ad_counters: DataFrame,
    user_counters: DataFrame,
    profiles: DataFrame,
    variant: Variant = MAIN,
    keep: tuple[str, ...] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Nested sample ``(keep…, label, feature)`` for every label row.

    Counters are looked up for the distinct dimension tuples of the labels, not per label and
    dimension set, so the number of sets does not multiply the wide label rows. One aggregation of
    the labels yields the tuples and, with them, which users and ads are hot; ``join_packed`` splits
    those, and equal rows of labels travel as one. The joins go from narrow to wide: each one shuffles what the earlier ones attached.
    """
    nation = ("nation",) if variant.nation_prefix else ()
    ad_tuple = [f"t_{d}" for d in (*nation, *AD_DIMS)]
    user_tuple = [f"t_{d}" for d in ("user_id", *USER_AD_DIMS)]
    # a missing user has no counters, hence no key text either
    rows = labels.withColumns({f"t_{d}": dim_text(d) for d in (*nation, *AD_DIMS)}).withColumn("t_user_id", F.col("user_id"))
    tuples = key_counts(rows, ["t_user_id", *ad_tuple])
    by_ad, by_user_ad, by_user = (key_counts(tuples, keys, "_n") for keys in (ad_tuple, user_tuple, ["t_user_id"]))
    if nation:
        ad_counters = ad_counters.withColumn("nation", dim_text("nation"))

    known = F.col("t_user_id").isNotNull()
    users = _slots(counted_keys(by_user_ad).where(known), user_counters, variant.user_sets, ("user_id",), variant, hot_rows, first=True)
    ads = _slots(counted_keys(by_ad), ad_counters, variant.ad_sets, nation, variant, hot_rows)
    owners = profiles.select(F.col("user_id").alias("t_user_id"), "userBase", "userBehavior")

    # equal label rows go through all three joins as one row per chunk
    joined = join_packed(chunked(rows), owners, ["t_user_id"], "left", hot_rows, by_user)
    joined = join_packed(joined, users, user_tuple, "left", hot_rows, by_user_ad)
    joined = join_packed(joined, ads, ad_tuple, "left", hot_rows, by_ad)
    return repeated(joined.drop("_hash")).select(*keep, _label(variant).alias("label"), _feature(variant).alias("feature"))


def _label(variant: Variant) -> Column:
    return F.struct(F.col("is_click").alias("click"), F.col("is_attr_install").alias(variant.install_field))


def _feature(variant: Variant) -> Column:
    # a key without counters shows as an empty cell
    empty = empty_cell(variant.install_field)

    def slots(sets) -> Column:
        return F.struct(*[F.coalesce(F.col(s.slot), empty).alias(s.slot) for s in sets])

    own, *combined = variant.user_sets
    context = {
        "posId": "pos_id", "appName": "package_name", **({"nation": "nation"} if variant.nation_prefix else {}),
        "osVersion": "os_version", "brand": "brand", "model": "model", "language": "system_language",
        "appVersionCode": "app_version_code", "clientIp": "client_ip", "reqTime": "server_time",
    }
    info = {
        "adId": F.col("ad_id"), "appId": F.col("ad_package_name"), "category": F.col("ad_package_category"),
        "isAutoDownload": F.col("is_auto_download"), "creativeId": dim_text("c_id"),
    }
    return F.struct(
        F.struct(F.col("user_id").alias("userId"), "userBase", "userBehavior", slots([own]).alias("userCounter")).alias("userProfile"),
        F.struct(slots(combined).alias("userAdCount")).alias("userAdFeature"),
        F.struct(*[F.col(c).alias(n) for n, c in context.items()]).alias("context"),
        F.struct(
            F.struct(*[c.alias(n) for n, c in info.items()]).alias("adInfo"),
            slots(variant.ad_sets).alias("adCounter"),
        ).alias("adData"),
    )


def sample_json(label: Column | str = "label", feature: Column | str = "feature") -> Column:
    """JSON text of a sample.

    Label, context and ad info keep missing values as ``null``; counters and profile parts leave
    them out, so an absent cell or profile reads ``{}``.
    """
    label, feature = (F.col(c) if isinstance(c, str) else c for c in (label, feature))

    def full(c: Column) -> Column:
        return F.to_json(c, {"ignoreNullFields": "false"})

    def sparse(c: Column) -> Column:
        return F.coalesce(F.to_json(c), F.lit("{}"))

    profile, data = feature["userProfile"], feature["adData"]
    user_id = open_object(full(F.struct(profile["userId"].alias("userId"))))
    return F.concat(
        F.lit('{"label":'), full(label),
        F.lit(',"feature":{"userProfile":'), user_id,
        F.lit(',"userBase":'), sparse(profile["userBase"]),
        F.lit(',"userBehavior":'), sparse(profile["userBehavior"]),
        F.lit(',"userCounter":'), sparse(profile["userCounter"]),
        F.lit('},"userAdFeature":'), sparse(feature["userAdFeature"]),
        F.lit(',"context":'), full(feature["context"]),
        F.lit(',"adData":{"adInfo":'), full(data["adInfo"]),
        F.lit(',"adCounter":'), sparse(data["adCounter"]),
        F.lit("}}}"),
    )


def join_logged_features(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the feature JSON logged for the same request, ad and creative; duplicates multiply.

    Both sides come straight from a scan and the request id is nearly unique, so counting hot keys
    would cost as much as the join; a hot id (an empty one, say) is split by adaptive execution.
    """
    f = features.select(F.col("request_id").alias("rid"), "ad_id", F.col("creative_id").alias("c_id"), "feature")
    return labels.join(f, ["rid", "ad_id", "c_id"])


def logged_sample_json(feature: Column | str = "feature", variant: Variant = MAIN) -> Column:
    """``{"label": …, "feature": …}`` with the logged feature document embedded as it is."""
    feature = F.col(feature) if isinstance(feature, str) else feature
    return F.concat(
        F.lit('{"label":'), F.to_json(_label(variant), {"ignoreNullFields": "false"}), F.lit(',"feature":'), feature, F.lit("}")
    )


def score_labels(labels: DataFrame, scored: DataFrame, package: str) -> DataFrame:
    """Labelled impressions of ``package`` with the scores logged for them, ids as text; joined as above."""
    a = labels.where(F.col("package_name") == package).select(
        F.col("rid").alias("request_id"), "beyla_id", "ad_package_name", F.col("ad_id").cast("string").alias("ad_id"),
        F.col("c_id").cast("string").alias("c_id"), "is_click", "is_attr_install", "bid_price",
    )
    b = scored.where(F.col("package_name") == package).select(
        "request_id", F.col("creative_id").cast("string").alias("c_id"), F.col("camp_id").cast("string").alias("ad_id"),
        F.col("app_id").alias("ad_package_name"), "pctr", "pcvr",
    )
    return a.join(b, ["request_id", "c_id", "ad_id", "ad_package_name"]).select(
        "beyla_id", "ad_package_name", "ad_id", "c_id", "pctr", "pcvr", "bid_price", "is_click", "is_attr_install"
    )
