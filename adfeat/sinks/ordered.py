"""Text artefacts whose lines have one order over several files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adfeat import schemas

LINES_PER_FILE = 1_000_000
PARTS = "part int, n_lines bigint, before bigint"


def write_ordered(rows: DataFrame, line: Column, by: list[str], path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """The ``line`` of each row, ordered by ``by`` within and over files of about ``lines_per_file``.

    Rows are sorted range by range, none of them all. A manifest has the order of the files, the lines of each and how many
    come before it: a row per file, the only thing that is put in order in one place."""
    spark = rows.sparkSession
    files = max(1, -(-rows.count() // lines_per_file))
    ranged = rows.repartitionByRange(files, *by).withColumn("part", F.spark_partition_id())
    # the part leads the order, so that the writer, which wants its lines by part, has no reason to sort again
    ranged.sortWithinPartitions("part", *by).select(line.alias("value"), "part").write.partitionBy("part").text(f"{path}/lines")
    written = spark.read.text(f"{path}/lines")
    counted = written.groupBy(F.col("part").cast("int").alias("part")).count().collect() if "part" in written.columns else []  # none: no lines
    counts = {r["part"]: r["count"] for r in counted}
    entries, before = [], 0
    for part in sorted(counts):
        entries.append((part, counts[part], before))
        before += counts[part]
    spark.createDataFrame(entries, PARTS).coalesce(1).write.json(f"{path}/order")


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """``(position, value)``: the lines with their place in the whole, from 0. A file is read by one task."""
    order = spark.read.schema(PARTS).json(f"{path}/order")
    if order.isEmpty():
        return spark.createDataFrame([], "position bigint, value string")
    files = spark.read.schema("value string, part int").text(f"{path}/lines", wholetext=True)
    lines = F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("at", "line")
    return files.join(F.broadcast(order), "part").select("before", lines).select(
        (F.col("before") + F.col("at")).alias("position"), F.col("line").alias("value"))


def write_calibration_model(model: DataFrame, path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """Model lines of five fields separated by spaces, by ascending score."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("bucket", "n", "clicks", "prate", "rate")])
    write_ordered(model, line, ["prate"], path, lines_per_file)


def read_calibration_model(spark: SparkSession, path: str) -> DataFrame:
    """Model rows of :func:`write_calibration_model` with their ``position``; a line that is none stops the job."""
    row = F.from_csv("value", F.lit(schemas.CALIBRATION_MODEL), {"sep": " ", "mode": "FAILFAST"})
    return read_ordered(spark, path).select("position", row.alias("m")).select("position", "m.*")
