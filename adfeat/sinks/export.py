"""Published artefacts: partitioned logs, snapshots, user entries, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adfeat.config import (
    ENTRY_TTL_SECONDS, INT32_MAX, MAIN, MEASURES, USER_COUNTER_KEY_PREFIX, USER_PROFILE_KEY_PREFIX, WINDOW_TAGS, Variant,
)
from adfeat.functions.jsontext import open_object
from adfeat.functions.keys import counter_key, dim_text
from adfeat.operators.counters import counter_cells


def write_hour_lines(lines: DataFrame, root: str, hour: str, mode: str = "errorifexists") -> None:
    """JSON lines (column ``value``, or any columns) under ``dt=/hour=``; an existing hour is an error."""
    text = lines if lines.columns == ["value"] else lines.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    text.write.mode(mode).text(f"{root}/dt={hour[:8]}/hour={hour[8:]}")


def tsv_lines(df: DataFrame) -> DataFrame:
    """Tab-separated text of all columns, missing values as ``None``."""
    return df.select(F.concat_ws("\t", *[dim_text(c) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    tsv_lines(df).write.mode(mode).text(path)


def write_hourly_tsv(df: DataFrame, root: str, hour: str = "hour", mode: str = "append") -> None:
    """TSV lines under ``hour=`` of each row's hour, which is no field of the line."""
    lines = df.select(F.concat_ws("\t", *[dim_text(c) for c in df.columns if c != hour]).alias("value"), F.col(hour).alias("hour"))
    lines.repartition("hour").write.mode(mode).partitionBy("hour").text(root)


def write_snapshot(df: DataFrame, root: str, day: str, mode: str = "errorifexists", by_set: bool = False) -> None:
    """Daily snapshot as Parquet under ``dt=``.

    ``by_set`` splits counters by dimension set, so that readers of a few sets skip the others."""
    writer = df.write.mode(mode)
    (writer.partitionBy("dim_set") if by_set else writer).parquet(f"{root}/dt={day}")


def entity_lines(entities: DataFrame) -> DataFrame:
    """``{"user_id": …, "pb": …}`` lines from ``(user_id, value)`` with JSON text in ``value``."""
    head = F.to_json(F.struct("user_id"), {"ignoreNullFields": "false"})
    return entities.select(F.concat(open_object(head), F.lit(',"pb":'), F.col("value"), F.lit("}")).alias("value"))


def register_hour(spark: SparkSession, table: str, hour: str, location: str | None = None) -> None:
    """Make a written hour visible in a table partitioned by ``dt`` and ``hour``; safe to repeat."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt='{hour[:8]}', hour='{hour[8:]}'){where}")


def user_counter_entries(
    counters: DataFrame,
    published_at: int,
    variant: Variant = MAIN,
    parts: int = 1,
) -> DataFrame:
    """``(entity_key, part, value, expire_at)`` with all counters of a user as one JSON document.

    ``parts`` above 1 splits the document of every user by key hash, whatever its size; the part is then
    the end of the entity key, ``#0`` to ``#parts-1``, so that no part overwrites another. Readers must
    use the same number (:func:`adfeat.sources.stores.lookup_users`).
    """
    cells = counter_cells(counters, variant, by=("user_id",)).select("user_id", counter_key().alias("k"), "cell")
    part = F.pmod(F.xxhash64("k"), F.lit(parts)).cast("int")
    docs = cells.groupBy("user_id", part.alias("part")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "cell")))).alias("storeUserCounter")
    )
    return _entries(docs, USER_COUNTER_KEY_PREFIX, F.to_json(F.struct("storeUserCounter")), published_at, parts)


def user_profile_entries(profiles: DataFrame, published_at: int) -> DataFrame:
    """``(entity_key, part, value, expire_at)`` of user profiles; a missing part is ``{}``."""
    parts = [F.coalesce(F.to_json(c), F.lit("{}")) for c in ("userBase", "userBehavior")]
    value = F.concat(F.lit('{"userBase":'), parts[0], F.lit(',"userBehavior":'), parts[1], F.lit("}"))
    return _entries(profiles.withColumn("part", F.lit(0)), USER_PROFILE_KEY_PREFIX, value, published_at)


def _entries(docs: DataFrame, prefix: str, value: Column, published_at: int, parts: int = 1) -> DataFrame:
    end = [F.lit("#"), F.col("part").cast("string")] if parts > 1 else []
    return docs.select(
        F.concat(F.lit(prefix), dim_text("user_id"), *end).alias("entity_key"), "part", value.alias("value"),
        F.lit(published_at + ENTRY_TTL_SECONDS).cast("bigint").alias("expire_at"),
    )


def publish_entries(entries: DataFrame, put, partitions: int | None = None) -> None:
    """Send entries to a key-value store from the tasks: ``put(iterator of rows)`` per partition.

    A lost task is run again, so ``put`` must overwrite (as a keyed set does)."""
    (entries if partitions is None else entries.repartition(partitions)).foreachPartition(put)


def invalid_counters(counters: DataFrame) -> DataFrame:
    """Rows that a strict consumer would refuse, with the reason: unknown window, or a count outside int32."""
    bad_count = [F.when((F.col(m) < 0) | (F.col(m) > INT32_MAX), F.lit(m)) for m in MEASURES]
    reason = F.coalesce(
        F.when(~F.coalesce(F.col("window_tag").isin(*WINDOW_TAGS), F.lit(False)), F.lit("window_tag")), *bad_count
    )
    return counters.withColumn("reason", reason).where(F.col("reason").isNotNull())


def merged_views(merged: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """Both published shapes of smoothed counters: nested under ``countFeatures30d``, and flat."""
    names = dict(zip(MEASURES, ("imp", "click", variant.install_field)))
    flat = F.struct(*[F.nullif(F.col(m), F.lit(0)).alias(n) for m, n in names.items()])
    return merged.select(
        counter_key().alias("counter_key"),
        F.to_json(F.struct(flat.alias("countFeatures30d"))).alias("nested"),
        F.to_json(flat).alias("flat"),
    )


def ad_info_documents(info: DataFrame) -> DataFrame:
    """``(info_key, value)`` with the entry as JSON text; fields an entry does not have are left out."""
    entry = F.struct(
        "category", F.col("creative_create_time").alias("creativeCreateTime"), F.col("day_attr_install_cap").alias("dayAttrInstallCap")
    )
    return info.select("info_key", F.to_json(entry).alias("value"))


def manifest(lines: DataFrame, column: str = "value", by: tuple[str, ...] = ()) -> DataFrame:
    """Row count and order-independent md5 checksum of a text artefact, per ``by`` group.

    Line digests are added up, so the checksum is combined map-side and does not depend on file order."""
    digest = F.conv(F.substring(F.md5(F.col(column)), 1, 15), 16, 10).cast("decimal(28,0)")
    return lines.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("_s")).select(
        *by, "n_rows", F.md5(F.concat_ws("|", F.col("n_rows").cast("string"), F.col("_s").cast("string"))).alias("checksum")
    )


def mutual_information_lines(mi: DataFrame) -> DataFrame:
    return tsv_lines(mi.select("feature", "n_values", "mi"))


def calibration_model_lines(model: DataFrame) -> DataFrame:
    """Model file: five fields separated by spaces, in one ordered file (one row per bucket at most)."""
    return model.orderBy("prate").select(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("bucket", "n", "clicks", "prate", "rate")]).alias("value"))
