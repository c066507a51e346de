import math
from collections import Counter, defaultdict
from decimal import Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from adfeat.functions.chi2 import quantile, upper_tail
from adfeat.operators import features

COUNTS = "fea_k string, fea_v string, click int, install int, imp bigint"
ROWS = [
    ("two", "a", 1, 0, 10), ("two", "a", 0, 0, 20), ("two", "b", 1, 1, 30), ("two", "b", 0, 0, 5),
    ("many", "a", 1, 1, 4), ("many", "b", 0, 0, 6), ("many", "c", 1, 0, 3), ("many", "c", 0, 0, 9), ("many", "d", 1, 0, 2),
    ("const", "x", 1, 1, 7), ("const", "x", 0, 0, 8),
    ("oneclass", "a", 0, 0, 3), ("oneclass", "b", 0, 0, 4),
]


def table(label, rows=ROWS):
    t = defaultdict(lambda: defaultdict(Counter))
    for k, v, click, install, imp in rows:
        if label == "click" or click > 0:
            t[k][v][click if label == "click" else install] += imp
    return t


def mi(values):
    n = sum(sum(c.values()) for c in values.values())
    y = Counter()
    for c in values.values():
        y.update(c)
    return sum(
        x / n * math.log2((x / n) / ((sum(c.values()) / n) * (y[l] / n))) for c in values.values() for l, x in c.items() if x
    )


@pytest.mark.parametrize("label", ["click", "install"])
def test_mutual_information(spark, label):
    got = {r.feature: (r.n_values, r.mi) for r in features.mutual_information(spark.createDataFrame(ROWS, COUNTS), label).collect()}
    want = table(label)
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k][0] == len(values)
        classes = {l for c in values.values() for l, x in c.items() if x}
        if len(classes) < 2:
            assert got[k][1] is None
        else:
            assert got[k][1] == pytest.approx(mi(values), abs=1e-12)
    if label == "click":
        assert got["const"][1] == pytest.approx(0, abs=1e-12)


def test_chi_square(spark):
    df = spark.createDataFrame(ROWS, COUNTS)
    got = {r.feature: r for r in features.chi_square(df).collect()}
    plain = {r.feature: r for r in features.chi_square(df, yates=False).collect()}
    for k, values in table("click").items():
        cells = [(c[1], c[0]) for c in values.values()]
        p, q = sum(c[0] for c in cells), sum(c[1] for c in cells)
        if p == 0 or q == 0 or len(cells) == 1:
            assert got[k].stat == -1 and got[k].dof is None
            continue
        pairs = [(o, sum(c) * m / (p + q)) for c in cells for o, m in zip(c, (p, q))]
        uncorrected = sum((o - e) ** 2 / e for o, e in pairs)
        assert plain[k].stat == pytest.approx(uncorrected, rel=1e-12)
        moved = sum((abs(o - e) - min(abs(o - e), 0.5)) ** 2 / e for o, e in pairs) if len(cells) == 2 else uncorrected
        assert got[k].stat == pytest.approx(moved, rel=1e-12)
        assert got[k].dof == len(cells) - 1


def test_chi_square_small_gap(spark):
    rows = [("f", "a", 1, 0, 10), ("f", "a", 0, 0, 10), ("f", "b", 1, 0, 10), ("f", "b", 0, 0, 10)]
    assert features.chi_square(spark.createDataFrame(rows, COUNTS)).first().stat == 0


# published values of the chi-square distribution
@pytest.mark.parametrize("dof, value", [(1, 1.6423744151498165), (2, 3.2188758248682006), (10, 13.441957574973111)])
def test_quantiles(dof, value):
    assert quantile(0.8, dof) == pytest.approx(value, rel=1e-9)


def test_upper_tail():
    assert upper_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert upper_tail(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert upper_tail(2.0, 2) == pytest.approx(math.exp(-1), rel=1e-12)
    assert upper_tail(0.0, 5) == 1.0
    # even degrees of freedom have a closed form, also just below and above the switch to the approximation
    for dof in (19_998, 20_002):
        x, h = dof * 1.01, dof * 1.01 / 2
        exact = math.fsum(math.exp(i * math.log(h) - h - math.lgamma(i + 1)) for i in range(dof // 2))
        assert upper_tail(x, dof) == pytest.approx(exact, rel=1e-4)


def test_chi_square_test(spark):
    got = {r.feature: r for r in features.chi_square_test(spark.createDataFrame(ROWS, COUNTS)).collect()}
    assert got["two"].critical == pytest.approx(1.6423744151498165)
    assert got["two"].p_value == pytest.approx(upper_tail(got["two"].stat, 1))
    assert got["const"].stat == -1 and got["const"].critical is None and got["const"].p_value is None


def test_counts_and_extractors(spark):
    samples = spark.createDataFrame([(1, 0, "a", None), (0, 0, "a", "z"), (0, 0, None, None)], "c int, i int, x string, y string")
    extract = features.column_extractor(F.col("c"), F.col("i"), {"x": F.col("x"), "y": F.col("y")})
    got = {tuple(r) for r in features.feature_label_counts(samples, extract).collect()}
    assert got == {("x", "a", 1, 0, 1), ("x", "a", 0, 0, 1), ("y", "z", 0, 0, 1)}

    def native(batches):
        for pdf in batches:
            yield pdf.assign(click=pdf.c, attr_install=pdf.i, int_features=[{"x": str(v)} for v in pdf.x])[["click", "attr_install", "int_features"]]

    got = {tuple(r) for r in features.feature_label_counts(samples, features.native_extractor(native)).collect()}
    assert got == {("x", "a", 1, 0, 1), ("x", "a", 0, 0, 1), ("x", "None", 0, 0, 1)}


def test_index_allocation(spark):
    names = ["up_uid", "ctx_ip", "user_ad_uac", "ad_ac/7d", "up_uc", "ctx_ne3", "ad_ai_cid", "ad_ai_aid", "x_ad_ai_adid", "ctx_ad_pkg", "other", "single"]
    rows = [(n, str(v), 0, 0, 1) for n in names for v in range(1 if n == "single" else 4)]
    df = spark.createDataFrame(rows, COUNTS)
    assert {r.name: r.size for r in features.index_allocation(df).collect()} == {
        "up_uid": 200_000, "ctx_ip": 100_000, "user_ad_uac": 5_000, "ad_ac/7d": 10_000, "up_uc": 5_000, "ad_ai_cid": 10_000,
        "ad_ai_aid": 3_000, "x_ad_ai_adid": 3_000, "ctx_ad_pkg": 12, "other": 40,
    }
    assert {r.name: r.size for r in features.index_allocation(df, compact=True).collect()} == {
        "up_uid": 40, "ctx_ip": 100_000, "user_ad_uac": 10_000, "ad_ac/7d": 10_000, "up_uc": 10_000, "ctx_ne3": 40, "ad_ai_cid": 10_000,
        "ad_ai_aid": 40, "x_ad_ai_adid": 40, "ctx_ad_pkg": 40, "other": 40,
    }


@pytest.mark.parametrize("n_values", [2, 5])
def test_chi_square_of_huge_counts(spark, n_values):
    rows, exact = [], []
    for v in range(n_values):
        m, pos = 10**12 + 7 * v, (10**12) // 3 + (-1) ** v * 10**5 * v
        rows += [("f", str(v), 1, 0, pos), ("f", str(v), 0, 0, m - pos)]
        exact.append((pos, m))
    p, n = sum(x for x, _ in exact), sum(m for _, m in exact)
    want = sum(Fraction(x * n - m * p) ** 2 / (m * p * (n - p)) for x, m in exact)
    got = features.chi_square(spark.createDataFrame(rows, COUNTS), yates=False).first()
    assert abs(Fraction(got.stat) / want - 1) < Fraction(1, 10**9)


def poisson_tail(h, a):
    """Upper tail for an even number of degrees of freedom, 2a, at 2h: a sum of so many exact terms."""
    with localcontext() as c:
        c.prec = 60
        term = total = Decimal(1)
        for k in range(1, a):
            term *= Decimal(h) / k
            total += term
        return float(total * (-Decimal(h)).exp())


@pytest.mark.parametrize("a", [1, 5, 500, 20_000, 100_000])
def test_tails_have_one_formula_at_every_size(a):
    for h in (a - 2.5 * math.sqrt(a), a - 1.0, a + 0.5, a + 3 * math.sqrt(a), 2.0 * a + 10):
        if h > 0:
            assert upper_tail(2 * h, 2 * a) == pytest.approx(poisson_tail(h, a), rel=1e-11)


def test_quantiles_invert_the_tail():
    for dof in (1, 2, 3, 9, 1000, 39_999, 40_001, 10**6, 10**9):
        for prob in (0.01, 0.5, 0.8, 0.999):
            assert 1 - upper_tail(quantile(prob, dof), dof) == pytest.approx(prob, abs=1e-11)
    assert quantile(0.0, 3) == 0.0 and upper_tail(-1, 3) == upper_tail(0, 3) == 1.0


def test_sums_that_do_not_settle_are_errors():
    with pytest.raises(ArithmeticError):
        upper_tail(math.nan, 3)
