"""Ad event stream: decoding, five-minute buckets, rolling day counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from adfeat import schemas
from adfeat.config import AD_PLATFORM, EVENT_NAMES
from adfeat.functions.jsontext import parsed_once
from adfeat.sinks.export import tsv_lines


def read_events(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Text ``value`` of a Kafka topic, from the newest offsets (offsets live in the query checkpoint)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "latest").options(**options).load().select(F.col("value").cast("string").alias("value"))


def decode_events(raw: DataFrame, packages, events=EVENT_NAMES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per advertised item of the event messages in ``value``.

    The message is JSON text inside a JSON envelope. Malformed messages, other platforms, packages or
    event names, and items without user, package, ad or creative id (missing or 0) are dropped.
    """
    message = F.from_json(F.from_json("value", schemas.STREAM_ENVELOPE)["message"], schemas.STREAM_MESSAGE)
    rows = parsed_once(raw, message, "m").where(
        (F.col("m.sub_pf") == AD_PLATFORM)
        & F.col("m.package_name").isin(*packages)
        & F.col("m.event_name").isin(*events)
        & (F.length("m.beyla_id") > 0)
    )
    items = rows.select(*keep, "m", F.explode("m.params").alias("p")).where(
        (F.length("p.ad_package_name") > 0)
        & (F.coalesce("p.campaign_id", F.lit("0")) != "0")
        & (F.coalesce("p.c_id", F.lit("0")) != "0")
    )
    return items.select(
        *keep, "m.event_name", "m.beyla_id", "m.package_name", F.coalesce("m.pos_id", F.lit("")).alias("pos_id"),
        "p.ad_package_name", F.col("p.campaign_id").alias("ad_id"), "p.c_id",
    )


def bucket_of(ts: Column, minutes: int = 5) -> Column:
    """``yyyyMMddHHmm`` of the slot of ``minutes`` that holds ``ts``."""
    seconds = 60 * minutes
    start = F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)
    return F.date_format(start, "yyyyMMddHHmm")


def write_buckets(events: DataFrame, path: str, checkpoint: str, every: str = "5 minutes", once: bool = False) -> StreamingQuery:
    """Append decoded events as TSV under ``bucket=yyyyMMddHHmm`` of the processing time.

    The file sink commits a batch once; after a failure the batch is replayed with its recorded
    time, so a restart neither loses nor repeats rows.
    """
    lines = tsv_lines(events).withColumn("bucket", bucket_of(F.current_timestamp()))
    writer = lines.writeStream.format("text").partitionBy("bucket").option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.outputMode("append").trigger(**trigger).start()


def rolling_day_counts(events: DataFrame, keys: list[str], ts: str = "ts", late: str | None = None) -> DataFrame:
    """Events per key over the 24 hours up to each full hour: ``(window_end, keys…, n)``.

    Counted per hour first, so an event is stored once and not in 24 overlapping windows. On a stream
    pass ``late``, the watermark delay.
    """
    source = events if late is None else events.withWatermark(ts, late)
    hourly = source.groupBy(F.window(ts, "1 hour"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return hourly.groupBy(F.window("window", "24 hours", "1 hour").alias("day"), *keys).agg(
        F.sum("n").alias("n")
    ).select(F.col("day.end").alias("window_end"), *keys, "n")


def write_rolling(events: DataFrame, keys: list[str], path: str, checkpoint: str, late: str, ts: str = "ts", every: str | None = None) -> StreamingQuery:
    """Rolling day counts of a stream as Parquet, each window once, when the watermark has passed it.

    Hours and days are kept in the state store below ``checkpoint``, so the stream goes on where it was stopped. A row of an
    hour that the watermark has passed (``late`` behind the latest one seen) is dropped. ``every`` None: until all is read."""
    counts = rolling_day_counts(events, keys, ts, late)
    writer = counts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**({"availableNow": True} if every is None else {"processingTime": every})).start()
