import random

import pytest
from pyspark.sql import functions as F

from adfeat.operators import ranking

EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 1.7976931348623157e308, -1e300, 1.0, 1.0000000000000002,
            0.9999999999999999, 2.0, 3.0, 0.1, 0.30000000000000004, 0.3, -0.3, 8.0, 7.999999999999999, 2.0**29, 2.0**29 - 1e-7]


def pairs(rows):
    good = total = 0.0
    for s, l in rows:
        for t, m in rows:
            if l == 1 and m != 1:
                total += 1
                good += 1 if s > t else 0.5 if s == t else 0
    return good / total


@pytest.mark.parametrize("seed", range(4))
def test_auc(spark, seed):
    rnd = random.Random(seed)
    kinds = [lambda: rnd.random(), lambda: rnd.choice([0.1, 0.2, 0.3]), lambda: rnd.gauss(0, 1e6), lambda: 0.01 + rnd.random() * 1e-12,
             lambda: rnd.choice(EXTREMES)]
    rows = [(rnd.choice(kinds)(), rnd.choice([0, 1, 2])) for _ in range(150)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = ranking.auc(df).first().auc
    assert got == pytest.approx(pairs(rows), abs=1e-12)
    assert ranking.auc(df.withColumn("score", -F.col("score"))).first().auc == pytest.approx(1 - got, abs=1e-12)


def test_digits_keep_the_order(spark):
    rnd = random.Random(1)
    scores = sorted(set(EXTREMES + [rnd.gauss(0, 1) for _ in range(300)] + [10 ** rnd.uniform(-300, 300) for _ in range(300)]
                        + [1 + i * 2**-52 for i in range(50)] + [2.0**i for i in range(-1074, 1024, 13)]))
    d1, d2 = ranking._digits(F.col("s"))
    rows = spark.createDataFrame([(s,) for s in scores], "s double").select("s", d1.alias("a"), d2.alias("b")).collect()
    by_score = [(r.a, r.b) for r in sorted(rows, key=lambda r: r.s)]
    assert by_score == sorted(by_score)


def test_one_class(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert ranking.auc(df).first().auc is None
    assert ranking.auc(df.limit(0)).first().auc is None


def ecpm(spark, rows):
    return ranking.ecpm_rows(spark.createDataFrame(rows, "pctcvr string, bid_price double, is_attr_install int"))


def test_bid_weighted(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["NULL", str(rnd.choice([0.1, 0.2, rnd.random()]))]), rnd.choice([1.0, 2.5]), rnd.choice([0, 1, 2])) for _ in range(120)]
    kept = [(float(p) * b * 1000, b, i > 0) for p, b, i in rows if p != "NULL"]
    right = wrong = 0.0
    for s, b, pos in kept:
        for t, _, other in kept:
            if pos != other and s >= t:
                w = b * (1 if s > t else 0.5)
                right, wrong = (right + w, wrong) if pos else (right, wrong + w)
    assert ranking.bid_weighted_auc(ecpm(spark, rows)).first().auc == pytest.approx(right / (right + wrong), abs=1e-12)


def test_equal_bids_give_the_auc(spark):
    rnd = random.Random(6)
    df = ecpm(spark, [(str(rnd.random()), 3.0, rnd.choice([0, 1])) for _ in range(100)])
    assert ranking.bid_weighted_auc(df).first().auc == pytest.approx(ranking.auc(df, "ecpm", "is_attr_install").first().auc, abs=1e-12)


def test_bad_score_text_stops(spark):
    with pytest.raises(Exception):
        ecpm(spark, [("abc", 1.0, 1)]).collect()


def test_only_digit_totals_meet_in_one_task(spark):
    df = spark.createDataFrame([(0.1, 1)], "score double, label int")
    plan = ranking.auc(df)._jdf.queryExecution().executedPlan().toString()
    # the last window and the final sum see one row per first digit
    assert plan.count("Exchange SinglePartition") == 1 and plan.count("Exchange hashpartitioning") == 3
