"""Helpers of the text operators: columns, lineage cuts in the shared folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20  # a side is broadcast only when its counted rows fit in this
FILE_ROWS = 100_000  # of a table of counted rows
WAVES, MERGED = 2, 16  # tasks that write, for each core at least; shuffle partitions that one of them writes at most, beyond that
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between the words of lower-cased text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a temporary one only for local masters."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def few(df: DataFrame) -> DataFrame:
    """The rows where they lie, in fewer tasks: WAVES for each core, or one for MERGED shuffle partitions if these are more.

    For what is written: on a local file system Hadoop starts a process for each file, which takes up the executor's own size once
    more for a moment, and anywhere many small files are slow to read. Tasks take their partitions one after the other."""
    spark = df.sparkSession
    return df.coalesce(max(WAVES * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // MERGED))


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows, kept in the shared folder by checkpoint(): later reads survive lost executors and compute nothing twice.

    Rows known to be `rows` at most are gathered first, in a file per FILE_ROWS of them and not one per task."""
    shared_dir(df.sparkSession)
    return (df if rows is None else df.repartition(max(1, -(-rows // FILE_ROWS)))).checkpoint()


def saved(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The rows, written as a Parquet table below the shared folder and read back (columns are pruned on later reads)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast if the counted rows fit; else leave the join to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def upto(n: Column) -> Column:
    """0 .. n-1 as an array, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def lower_words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, a-z and everything beyond ASCII. Null: none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def space_words(text: Column) -> Column:
    """Runs without ASCII white space. Null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def text_key() -> Column:
    """With doc_id, tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())


def on_doc(left: DataFrame, right: DataFrame, how: str = "left", size: int | None = None) -> DataFrame:
    """Join on doc_id (null equals null) and text_key; right is broadcast if its counted bytes are given and fit."""
    right = right.withColumnsRenamed({"doc_id": "__doc_id", "text_key": "__text_key"})
    right = right if size is None else small(right, 1, size)
    same = (F.col("text_key") == F.col("__text_key")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    return left.join(right, same, how).drop("__doc_id", "__text_key")


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def rows_without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The documents, all columns whatever their names, but for those of the (doc_id, text_key) in `bad`."""
    keyed = docs.select(whole_row(docs).alias("row"), "doc_id", text_key().alias("text_key"))
    return on_doc(keyed, bad.select("doc_id", "text_key"), "left_anti").select("row.*")


def numbered(df: DataFrame, key: str, task: Callable | None = None, schema: str = "") -> DataFrame:
    """The rows with `rank`: gapless from 0 within each value of an integer column, in no particular order. If a task is given
    (Arrow batches to batches, with their schema), its rows are numbered in the same pass.

    Each task numbers its own rows by value and the table is written once; the counts of (task, value) then give where each
    task starts. No value is ever gathered in one task, however many rows it holds.
    """

    def number(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches if task is None else task(batches):
            keys = batch.column(key).to_pandas()
            local = keys.groupby(keys).cumcount() + keys.map(seen).fillna(0).astype("int64")
            for value, count in keys.value_counts().items():
                seen[value] = seen.get(value, 0) + count
            columns = [*batch.columns, pa.array([part] * len(keys), pa.int32()), pa.array(local.to_numpy(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "local"])

    made = T.StructType.fromDDL(schema) if schema else df.schema
    rows = saved(few(df).mapInArrow(number, T.StructType([*made.fields, T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = cut(few(rows.groupBy("part", key).count().select("part", key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))))
    joined = rows.join(small(base, base.count(), 32), ["part", key])
    return joined.withColumn("rank", F.col("local") + F.col("base")).drop("part", "local", "base")
