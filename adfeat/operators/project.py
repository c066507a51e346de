"""Row filters and projections of the raw event tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adfeat import schemas
from adfeat.config import AD_PLATFORM, EVENT_NAMES
from adfeat.functions.jsontext import must_have, parsed_once
from adfeat.functions.keys import is_ascii

IMP_CLICK_COLUMNS = (
    "requestid", "beyla_id", "country", "pos_id", "package_name", "event_name", "ad_package_name", "ad_id", "c_id",
)
INSTALL_COLUMNS = (
    "requestid", "beyla_id", "country", "pos_id", "package_name", "ad_package_name", "ad_id", "c_id",
)


def project_imp_click(log: DataFrame, packages, ascii_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Impressions and clicks of the allowed packages; ad fields come from the JSON in ``succ_camp``.

    The filters are on plain columns and reach the Parquet scan before any JSON is parsed.
    ``ascii_only`` drops rows holding non-ASCII text; ``keep`` passes partition columns through.
    """
    wanted = log.where(
        (F.col("sub_platform") == AD_PLATFORM)
        & F.col("package_name").isin(*packages)
        & F.col("event_name").isin(*EVENT_NAMES)
    )
    rows = parsed_once(wanted, F.from_json("succ_camp", schemas.SUCC_CAMP, {"mode": "FAILFAST"}), "camp")

    def camp(name: str):
        return must_have(F.col(f"camp.{name}"), name, F.col("succ_camp"))

    out = rows.select(
        "requestid", "beyla_id", "country", "pos_id", "package_name", "event_name",
        camp("ad_package_name").alias("ad_package_name"),
        camp("campaign_id").alias("ad_id"),
        camp("c_id").alias("c_id"),
        *keep,
    )
    if ascii_only:
        out = out.where(reduce(lambda a, b: a & b, [F.coalesce(is_ascii(c), F.lit(True)) for c in IMP_CLICK_COLUMNS]))
    return out


def project_install(log: DataFrame, packages, keep: tuple[str, ...] = ()) -> DataFrame:
    """Install postbacks of the allowed packages under the column names of the impression table."""
    rows = log.where((F.col("source") == AD_PLATFORM) & F.col("channel_pkg").isin(*packages))
    return rows.select(
        "requestid", "beyla_id", F.col("nation").alias("country"), F.col("placement").alias("pos_id"),
        F.col("channel_pkg").alias("package_name"), F.col("pkg_name").alias("ad_package_name"),
        F.col("cpi_camp_id").cast("string").alias("ad_id"), F.col("c_id").cast("string").alias("c_id"), *keep,
    )


def exclude_package(installs: DataFrame, package: str) -> DataFrame:
    """Installs not credited to ``package``; rows without a package stay."""
    return installs.where(~F.col("package_name").eqNullSafe(package))
