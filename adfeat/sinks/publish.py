"""Artefacts that become visible only after they were checked, and readers that see one version at a time.

An artefact is written beside the published ones, read back and checked. Only then a row of the manifest names it; readers
follow the newest row. A refused or half-written version is never named, hence never read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat.operators.skew import comparable
from adfeat.sinks.export import invalid_counters

MANIFEST = "version bigint, path string, n_rows bigint, checksum string, published_at timestamp"


class Refused(Exception):
    """An artefact that did not pass its checks; ``bad`` has the rows, ``path`` is where it lies."""

    def __init__(self, bad: DataFrame, path: str, reason: str):
        super().__init__(reason)
        self.bad, self.path = bad, path


def checksum(rows: DataFrame) -> DataFrame:
    """``(n_rows, checksum)`` of rows in any order: hashes are added up, so they are combined map-side."""
    digest = F.xxhash64(*[comparable(F.col(c), rows.schema[c].dataType) for c in rows.columns]).cast("decimal(28,0)")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("_s")).select(
        "n_rows", F.md5(F.concat_ws("|", F.col("n_rows").cast("string"), F.coalesce(F.col("_s"), F.lit(0)).cast("string"))).alias("checksum"))


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    """All versions that were published under ``root``."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], MANIFEST)


def current(spark: SparkSession, root: str):
    """Manifest row of the newest version, or None."""
    return manifest_of(spark, root).orderBy(F.desc("version")).first()


def publish(
    rows: DataFrame,
    root: str,
    check: Callable[[DataFrame], DataFrame] = invalid_counters,
    partition_by: tuple[str, ...] = (),
    now: dt.datetime | None = None,
) -> int:
    """Write ``rows`` beside the published versions, check what was written and name it in the manifest; gives its version.

    ``check`` maps the rows to those that a consumer would refuse: if there are any, :class:`Refused` is raised and readers
    go on with the version before. One writer per ``root``.
    """
    spark, path = rows.sparkSession, f"{root}/versions/{uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    bad = check(written)
    if not bad.isEmpty():
        raise Refused(bad, path, f"rows refused by {getattr(check, '__name__', 'the check')}: {bad.limit(3).collect()}")
    found, last = checksum(written.select(*rows.columns)).first(), current(spark, root)
    version = 1 if last is None else last.version + 1
    entry = spark.createDataFrame([(version, path, found.n_rows, found.checksum, now or dt.datetime.now())], MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/manifest")  # one file, visible as a whole or not at all
    return version


def read_published(spark: SparkSession, root: str, schema=None, version: int | None = None) -> DataFrame:
    """Rows of the newest (or a given) published version."""
    rows = manifest_of(spark, root)
    entry = current(spark, root) if version is None else rows.where(F.col("version") == version).first()
    if entry is None:
        raise FileNotFoundError(f"nothing published under {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(entry.path)


def verified(rows: DataFrame, entry) -> bool:
    """Whether rows read back are those that were published."""
    found = checksum(rows).first()
    return (found.n_rows, found.checksum) == (entry.n_rows, entry.checksum)
