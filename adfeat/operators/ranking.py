"""Ranking metrics over scored rows, without a global sort or a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Binary digits of a score: sign, exponent and 8 mantissa bits, then 22 bits, then the score itself.
HEAD = 256.0
TAIL = float(1 << 22)


def _digits(score: Column) -> tuple[Column, Column]:
    """Two whole numbers whose lexicographic order never contradicts the order of finite scores.

    A value of the first digit is one of few thousand; within it the second takes up to 2^22 values,
    and about as many distinct doubles share both. So no group below outgrows the number format,
    whatever the number of rows.
    """
    size = F.abs(score)
    exponent = F.when(size > 0, F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1000))).otherwise(-1000)
    mantissa = F.least(size * F.pow(F.lit(2.0), -exponent), F.lit(2.0)) * HEAD
    head = F.floor(mantissa)
    sign = F.signum(score).cast("int")
    return sign * ((exponent + 1001) * 1024 + head), sign * F.floor((mantissa - head) * TAIL)


def ranked_pair_sums(rows: DataFrame, score: str, measures: dict[str, Column], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """For each pair ``name: (a, b)`` the sum over rows of ``a`` times the ``b`` ranked strictly below,
    plus half of the product among rows of equal score; also the total of every measure. One row.

    Two rows are compared at the first digit in which their scores differ: products are summed per
    distinct score within the same digits, then per second digit, then per first digit. Every step
    aggregates map-side first, and its window covers the values of one digit only.
    """
    d1, d2 = _digits(F.col("_s"))
    level = rows.where(F.col(score).isNotNull()).select(F.col(score).alias("_s"), *[c.cast("double").alias(m) for m, c in measures.items()])
    level = level.groupBy("_s").agg(*[F.sum(m).alias(m) for m in measures]).withColumns(
        {"_d1": d1, "_d2": d2, **{p: F.col(a) * F.col(b) / 2 for p, (a, b) in pairs.items()}}
    )
    for group, order in ((["_d1", "_d2"], "_s"), (["_d1"], "_d2"), ([], "_d1")):
        below = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumns({f"_b_{b}": F.coalesce(F.sum(b).over(below), F.lit(0.0)) for b in {b for _, b in pairs.values()}})
        level = level.groupBy(*group).agg(
            *[F.sum(m).alias(m) for m in measures],
            *[F.sum(F.col(p) + F.col(a) * F.col(f"_b_{b}")).alias(p) for p, (a, b) in pairs.items()],
        )
    return level


def auc(rows: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve; positive means ``label == 1``. Ties count half; null for one class only."""
    pos = F.coalesce((F.col(label) == 1).cast("int"), F.lit(0))
    sums = ranked_pair_sums(rows, score, {"pos": pos, "neg": 1 - pos}, {"area": ("pos", "neg")})
    return sums.select(F.try_divide("area", F.col("pos") * F.col("neg")).alias("auc"))


def ecpm_rows(rows: DataFrame) -> DataFrame:
    """Rows with a numeric ``pctcvr`` text and their ``ecpm``; the text ``NULL`` marks a missing score."""
    p = F.col("pctcvr").cast("string")
    return rows.where(p != "NULL").withColumn("ecpm", p.cast("double") * F.col("bid_price") * 1000)


def bid_weighted_auc(rows: DataFrame) -> DataFrame:
    """Share of correctly ordered positive-negative pairs when ranked by ``ecpm``, a pair weighing
    the bid of its higher row; ties count half for both. Null without any pair."""
    pos = F.coalesce((F.col("is_attr_install") > 0).cast("int"), F.lit(0))
    measures = {"pos": pos, "neg": 1 - pos, "pos_bid": pos * F.col("bid_price"), "neg_bid": (1 - pos) * F.col("bid_price")}
    sums = ranked_pair_sums(rows, "ecpm", measures, {"right": ("pos_bid", "neg"), "wrong": ("neg_bid", "pos")})
    return sums.select(F.try_divide(F.col("right"), F.col("right") + F.col("wrong")).alias("auc"))
