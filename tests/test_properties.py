"""Properties of the small Python helpers."""

import bisect
import datetime as dt

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adfeat.functions.chi2 import quantile, upper_tail
from adfeat.functions.timing import local_day_hours, shifted_partition
from adfeat.operators.calibration import _pool_borders, _pooled

bucket = st.integers(1, 12).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n)))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 10_000), bucket, min_size=1, max_size=25))
def test_pooling(buckets):
    keys = sorted(buckets)
    out = _pool_borders(pd.DataFrame([(k, *buckets[k], 0) for k in reversed(keys)], columns=["bucket", "n", "clicks", "range"]))
    out = out.assign(rate=out["clicks"] / out["n"])
    assert out["n"].sum() == sum(n for n, _ in buckets.values()) and out["clicks"].sum() == sum(c for _, c in buckets.values())
    assert list(out["rate"]) == sorted(out["rate"]) and out["bucket"].iloc[0] == keys[0]
    counts = [buckets[k] for k in keys]
    for i, k in enumerate(keys):
        fit = max(
            min(sum(c for _, c in counts[j : e + 1]) / sum(n for n, _ in counts[j : e + 1]) for e in range(i, len(keys)))
            for j in range(i + 1)
        )
        assert out["rate"].iloc[bisect.bisect_right(list(out["bucket"]), k) - 1] == pytest.approx(fit, abs=1e-12)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 10_000), bucket, min_size=1, max_size=25), st.integers(0, 25))
def test_pooling_ranges_first_changes_nothing(buckets, cut):
    rows = [(k, *buckets[k]) for k in sorted(buckets)]
    assert _pooled([*_pooled(rows[:cut]), *_pooled(rows[cut:])]) == _pooled(rows)


@settings(max_examples=100, deadline=None)
@given(st.floats(0.01, 0.99), st.integers(1, 400))
def test_quantile_and_tail_agree(prob, dof):
    assert upper_tail(quantile(prob, dof), dof) == pytest.approx(1 - prob, abs=1e-9)


@given(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1)))
def test_local_day_holds_now(now):
    begin, end = local_day_hours(now)
    assert begin <= now.strftime("%Y%m%d%H") < end and begin[8:] == end[8:] == "16"


@given(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1)))
def test_shift_is_undone(now):
    hour = now.strftime("%Y%m%d%H")
    assert shifted_partition(shifted_partition(hour, 8, "%Y%m%d%H"), -8, "%Y%m%d%H") == hour
