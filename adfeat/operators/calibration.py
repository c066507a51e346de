"""Score calibration: buckets, isotonic model, lookup and bias."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from adfeat.functions.lineage import cut

# the tasks carry the pooling functions, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS_PER_UNIT = 10_000.0
RANGE_ROWS = 100_000  # blocks that one task pools
LOOKUP_ROWS = 1_000_000  # a model of at most so many rows (16 bytes each) is broadcast
BLOCKS = "bucket bigint, n bigint, clicks bigint"
MODEL_SCHEMA = f"{BLOCKS}, prate double, rate double"


def ctr_buckets(rows: DataFrame, score: str = "pctr", label: str = "is_click") -> DataFrame:
    """Rows and clicks per truncated score bucket."""
    return rows.groupBy((F.col(score) * BUCKETS_PER_UNIT).cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("clicks")
    )


def _falls(left, right) -> bool:
    """Whether the click rate falls from one (bucket, n, clicks) to the next, compared in whole numbers."""
    return right[2] * left[1] < left[2] * right[1]


def _pooled(rows: Iterable[tuple]) -> list[list]:
    """Blocks of rows in bucket order: neighbours whose rate falls become one under the left key. What follows stays."""
    blocks: list[list] = []
    for row in rows:
        blocks.append(list(row))
        while len(blocks) > 1 and _falls(blocks[-2], blocks[-1]):
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    return blocks


def _pool_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = (row for batch in batches for row in batch[["bucket", "n", "clicks"]].itertuples(index=False, name=None))
    blocks = pd.DataFrame(_pooled(rows), columns=["bucket", "n", "clicks"])
    yield blocks.assign(range=TaskContext.get().partitionId())


def _pool_borders(blocks: pd.DataFrame) -> pd.DataFrame:
    rows = blocks.sort_values("bucket")[["bucket", "n", "clicks", "range"]].itertuples(index=False, name=None)
    return pd.DataFrame(_pooled(rows), columns=["bucket", "n", "clicks", "range"])


def _falling_borders(edges: list[Row]) -> list[tuple[int, int]]:
    """Neighbouring ranges between which the rate falls; no range is in two pairs."""
    pairs, taken = [], None
    for left, right in zip(edges, edges[1:]):
        if left.range != taken and _falls(left.last, right.first):
            pairs.append((left.range, right.range))
            taken = right.range
    return pairs


def isotonic_model(buckets: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Non-decreasing click rate by pooling neighbouring buckets: ``(bucket, n, clicks, prate, rate)``.

    Buckets are sorted into ranges of about ``range_rows`` and each is pooled by itself. Where the rate then falls from
    one range to the next, the two are pooled together, all such pairs at once, until it falls nowhere. Which buckets
    end up in one block does not depend on the order of pooling, as equal rates stay apart and rates are compared in
    whole numbers. A task holds two ranges at most, the driver the first and last block of each range. Rows without a
    bucket are left out.
    """
    rows = cut(buckets.where(F.col("bucket").isNotNull()).select(*[F.col(c).cast("bigint") for c in ("bucket", "n", "clicks")]))
    ranges = max(1, -(-rows.count() // range_rows))
    blocks = cut(rows.repartitionByRange(ranges, "bucket").sortWithinPartitions("bucket").mapInPandas(_pool_partition, f"{BLOCKS}, range int"))
    ends = F.struct("bucket", "n", "clicks")
    while True:
        edges = blocks.groupBy("range").agg(F.min(ends).alias("first"), F.max(ends).alias("last")).collect()
        pairs = _falling_borders(sorted(edges, key=lambda e: e.range))
        if not pairs:
            break
        # two rows per pair of ranges at most
        members = F.broadcast(blocks.sparkSession.createDataFrame([(r, pair[0]) for pair in pairs for r in pair], "range int, pair int"))
        merged = blocks.join(members, "range").groupBy("pair").applyInPandas(_pool_borders, f"{BLOCKS}, range int")
        blocks = cut(blocks.join(members, "range", "left_anti").select("bucket", "n", "clicks", "range").unionByName(merged))
    return blocks.select("bucket", "n", "clicks", (F.col("bucket") / BUCKETS_PER_UNIT).alias("prate"), (F.col("clicks") / F.col("n")).alias("rate"))


def calibrate(
    rows: DataFrame, model: DataFrame, score: str = "pctr", match: str = "strict", out: str = "calibrated", lookup_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """``rows`` with the rate of the last model row below ``score``; scores below the model take its first row.

    ``match='strict'`` looks at model rows strictly below the score, ``'inclusive'`` also at an equal one. A model of up
    to ``lookup_rows`` rows is broadcast as two sorted arrays, and the scores are searched in them where the rows are. A
    larger one is sorted together with the rows, range by range (:func:`_swept`). A missing score gets no rate, nor does
    any score from an empty model.
    """
    assert match in ("strict", "inclusive")
    steps = model.select(F.col("prate").cast("double").alias("at"), F.col("rate").cast("double").alias("rate"))
    if steps.limit(lookup_rows + 1).count() > lookup_rows:
        return _swept(rows, steps, score, match, out)
    known = steps.orderBy("at").toArrow()
    if not known.num_rows:
        return rows.withColumn(out, F.lit(None).cast("double"))
    shared = rows.sparkSession.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("at", "rate")))
    side = "left" if match == "strict" else "right"

    @F.pandas_udf(DoubleType())
    def rate_at(scores: pd.Series) -> pd.Series:
        at, rate = shared.value
        found = rate[np.maximum(np.searchsorted(at, scores.to_numpy("float64"), side) - 1, 0)]
        return pd.Series(found).where(scores.notna().to_numpy())

    return rows.withColumn(out, rate_at(F.col(score).cast("double")))


def _filled(carried: dict[int, float], out: str) -> Callable:
    """Rates carried from model rows to the rows after them; model rows are dropped."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            last = carried[batch.column("part")[0].as_py()] if last is None else last
            rates = np.concatenate([[last], batch.column("rate").to_numpy(zero_copy_only=False)])
            is_step = np.concatenate([[True], batch.column("is_step").to_numpy(zero_copy_only=False)])
            rates = rates[np.maximum.accumulate(np.where(is_step, np.arange(len(rates)), 0))]
            last = rates[-1]
            mine = pa.array(~is_step[1:])
            row = batch.column("row").filter(mine)
            names = [f.name for f in row.type]
            yield pa.RecordBatch.from_arrays([*row.flatten(), pa.array(rates[1:], pa.float64()).filter(mine)], names=[*names, out])

    return task


def _swept(rows: DataFrame, steps: DataFrame, score: str, match: str, out: str) -> DataFrame:
    """The lookup for models of any size: rows and model in one order, each task going on with the last rate before it.

    Equal scores are dealt over several ranges by a hash of the row."""
    kinds = rows.drop(out).schema
    rows = rows.drop(out)
    texts = F.to_json(F.struct(*[F.col(c).cast("string") for c in rows.columns]))
    scored = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).select(
        F.col(score).cast("double").alias("at"), F.lit(match == "inclusive").alias("after"), F.xxhash64(texts).alias("deal"),
        F.lit(False).alias("is_step"), F.lit(None).cast("double").alias("rate"), F.struct(*rows.columns).alias("row"))
    marks = steps.select(
        "at", F.lit(match == "strict").alias("after"), F.lit(0).cast("bigint").alias("deal"), F.lit(True).alias("is_step"), "rate",
        F.lit(None).cast(kinds).alias("row"))
    order = ["at", "after", "deal"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = scored.unionByName(marks).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("part", F.spark_partition_id()))
    first = steps.orderBy("at").first().rate
    ends = {r.part: r.rate for r in ranged.where("is_step").groupBy("part").agg(F.max_by("rate", "at").alias("rate")).collect()}
    carried = {}
    for part in range(tasks):  # the rate of the last model row before each range
        carried[part] = first
        first = ends.get(part, first)
    found = ranged.mapInArrow(_filled(carried, out), StructType([*kinds.fields, StructField(out, DoubleType())]))
    missing = rows.where(F.col(score).isNull() | F.isnan(F.col(score).cast("double"))).withColumn(out, F.lit(None).cast("double"))
    return found.unionByName(missing)


def calibration_bias(rows: DataFrame, model: DataFrame, match: str = "strict") -> DataFrame:
    """Mean of calibrated click rate times ``pcvr``, next to the mean install label."""
    return calibrate(rows, model, match=match).agg(
        F.avg(F.col("calibrated") * F.col("pcvr")).alias("mean_score"),
        F.avg(F.col("is_attr_install")).alias("mean_label"),
    )
