import bisect
import random

import pytest

from adfeat.operators import calibration as cal


def model_rows(spark, buckets):
    df = spark.createDataFrame(buckets, "bucket bigint, n bigint, clicks bigint")
    return sorted(cal.isotonic_model(df).collect(), key=lambda r: r.bucket)


def test_equal_neighbours_stay_apart(spark):
    rows = model_rows(spark, [(1, 10, 2), (2, 20, 4), (5, 10, 5), (6, 10, 1), (9, 1, 1)])
    assert [tuple(r) for r in rows] == [
        (1, 10, 2, 0.0001, 0.2), (2, 20, 4, 0.0002, 0.2), (5, 20, 6, 0.0005, 0.3), (9, 1, 1, 0.0009, 1.0),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_minmax_identity(spark, seed):
    rnd = random.Random(seed)
    buckets = [(b, n, rnd.randint(0, n)) for b in sorted(rnd.sample(range(1000), 40)) for n in [rnd.randint(1, 30)]]
    rows = model_rows(spark, buckets)
    assert sum(r.n for r in rows) == sum(b[1] for b in buckets) and sum(r.clicks for r in rows) == sum(b[2] for b in buckets)
    rates = [r.rate for r in rows]
    assert rates == sorted(rates)
    keys = [r.bucket for r in rows]
    for i, (b, _, _) in enumerate(buckets):
        fit = max(
            min(sum(x[2] for x in buckets[j : k + 1]) / sum(x[1] for x in buckets[j : k + 1]) for k in range(i, len(buckets)))
            for j in range(i + 1)
        )
        assert rates[bisect.bisect_right(keys, b) - 1] == pytest.approx(fit, abs=1e-12)


def test_bucket_truncates_the_double(spark):
    df = spark.createDataFrame([(0.0003, 1), (0.0003, 0), (0.07, 1)], "pctr double, is_click int")
    assert {r.bucket: (r.n, r.clicks) for r in cal.ctr_buckets(df).collect()} == {2: (2, 1), int(0.07 * 10000): (1, 1)}


@pytest.mark.parametrize("match", ["strict", "inclusive"])
def test_lookup(spark, match):
    keys = [3, 7, 29, 700, 701, 9999]
    model = [(k, 1, 1, k / 10000.0, i / 10) for i, k in enumerate(keys)]
    prates = [m[3] for m in model]
    scores = [0.0, 1.0, 0.5] + [s for p in prates for s in (p, p - 1e-12, p + 1e-12, p - 0.00005, p + 0.00005)]
    scores += [k / 10000.0 for k in range(0, 10001, 7)]
    rows = spark.createDataFrame([(s,) for s in scores] + [(None,)], "pctr double")
    m = spark.createDataFrame(model, cal.MODEL_SCHEMA)
    got = {r.pctr: r.calibrated for r in cal.calibrate(rows, m, match=match).collect()}
    side = bisect.bisect_left if match == "strict" else bisect.bisect_right
    for s in scores:
        assert got[s] == model[max(side(prates, s) - 1, 0)][4], s
    assert got[None] is None


def test_bias(spark):
    model = spark.createDataFrame([(0, 1, 1, 0.0, 0.1), (5000, 1, 1, 0.5, 0.5)], cal.MODEL_SCHEMA)
    rows = spark.createDataFrame([(0.2, 0.5, 1), (0.9, 0.2, 0)], "pctr double, pcvr double, is_attr_install int")
    r = cal.calibration_bias(rows, model).first()
    assert (r.mean_score, r.mean_label) == (pytest.approx((0.05 + 0.1) / 2), 0.5)


@pytest.mark.parametrize("shape", ["mixed", "falling", "rising", "waves"])
def test_ranges_pool_like_one(spark, shape):
    rnd = random.Random(4)
    rates = {"mixed": lambda i: rnd.random(), "falling": lambda i: 1 - i / 400, "rising": lambda i: i / 400, "waves": lambda i: (i % 50) / 50}
    buckets = []
    for i, b in enumerate(sorted(rnd.sample(range(-3_000_000, 3_000_000), 400))):
        n = rnd.randint(1, 40)
        buckets.append((b, n, round(n * rates[shape](i))))
    df = spark.createDataFrame(buckets, "bucket bigint, n bigint, clicks bigint")
    want = [tuple(x) for x in cal._pooled(sorted(buckets))]
    for range_rows in (60, 1000):
        rows = cal.isotonic_model(df, range_rows).collect()
        assert sorted((r.bucket, r.n, r.clicks) for r in rows) == want


def test_no_group_of_everything(spark, monkeypatch):
    sizes = []
    pairs = cal._falling_borders
    monkeypatch.setattr(cal, "_falling_borders", lambda edges: sizes.append(pairs(edges)) or sizes[-1])
    df = spark.range(1000).selectExpr("id AS bucket", "10L AS n", "10L - id div 100 AS clicks")
    assert cal.isotonic_model(df, 200).count() == 1
    for taken in sizes:  # every round pools disjoint pairs of neighbours
        members = [r for pair in taken for r in pair]
        assert len(members) == len(set(members))
    plan = cal.isotonic_model(df, 1000)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_no_buckets_give_no_model(spark):
    assert model_rows(spark, []) == [] and model_rows(spark, [(None, 3, 1)]) == []
    rows = spark.createDataFrame([(0.5,)], "pctr double")
    none = spark.createDataFrame([], cal.MODEL_SCHEMA)
    assert cal.calibrate(rows, none).first().calibrated is None


@pytest.mark.parametrize("match", ["strict", "inclusive"])
def test_large_models_are_swept(spark, rows_of, match):
    rnd = random.Random(8)
    model = spark.createDataFrame([(b, 1, 1, b / 10000.0, i / 10) for i, b in enumerate(sorted(rnd.sample(range(-900, 900), 60)))], cal.MODEL_SCHEMA)
    scores = [rnd.randint(-1000, 1000) / 10000.0 for _ in range(300)] + [0.01] * 200 + [None, float("nan"), -5.0, 150.0]
    rows = spark.createDataFrame([(i, s, {"a": i}, "clash") for i, s in enumerate(scores)], "i int, pctr double, m map<string, int>, calibrated string")
    want = rows_of(cal.calibrate(rows, model, match=match).select("i", "m", "calibrated"))
    assert rows_of(cal.calibrate(rows, model, match=match, lookup_rows=10).select("i", "m", "calibrated")) == want
    assert [r[2] for r in want if r[0] in (500, 501)] == [None, None]
