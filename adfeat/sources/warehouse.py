"""Warehouse tables under the column names the operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat.sources.logs import scan_table

# Column names of the warehouse tables and their names here.
ACCU_COLUMNS = {
    "beyla_id": "user_id", "req_country": "nation", "tag": "window_tag", "imp_sum": "imp", "click_sum": "click",
    "attr_install_sum": "attr_install", "install_sum": "attr_install",
}
LABEL_COLUMNS = {"beyla_id": "user_id", "req_country": "nation", "is_install": "is_attr_install"}
USER_COLUMNS = {"beyla_id": "user_id"}


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def read_accu(spark: SparkSession, table: str, day: str, tag: str | None = None, nation: str | None = None) -> DataFrame:
    """Accumulated counts of a day, optionally of one window tag and one nation."""
    rows = _renamed(scan_table(spark, table, day), ACCU_COLUMNS)
    if tag is not None:
        rows = rows.where(F.col("window_tag") == tag)
    return rows if nation is None else rows.where(F.col("nation") == nation)


def read_labels(spark: SparkSession, table: str, day: str, packages=None, nation: str | None = None) -> DataFrame:
    """Label rows of a day, optionally of some packages or one nation."""
    rows = _renamed(scan_table(spark, table, day), LABEL_COLUMNS)
    if packages:
        rows = rows.where(F.col("package_name").isin(*packages))
    return rows if nation is None else rows.where(F.col("nation") == nation)


def read_user_base(spark: SparkSession, table: str) -> DataFrame:
    return _renamed(scan_table(spark, table), USER_COLUMNS)


def read_behaviour(spark: SparkSession, table: str, day: str) -> DataFrame:
    return _renamed(scan_table(spark, table, day), USER_COLUMNS)
