import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from adfeat.config import SmoothingRules
from adfeat.functions.timing import local_day_hours
from adfeat.operators import counters, refresh

LONG = "dim_set string, dim_key string, window_tag string, imp bigint, click bigint, attr_install bigint"


def test_refresh_snapshot(spark):
    snapshot = spark.createDataFrame(
        [
            ("ad_id", "1", "1d", 9, 9, 9), ("ad_id", "1", "3d", 10, 1, 0), ("ad_id", "1", "14d", 50, 5, 5),
            ("ad_id", "2", "1d", 7, 7, 7), ("ad_id", "2", "Bj1d", 0, 0, 6),
        ],
        LONG,
    )
    recount = spark.createDataFrame([("ad_id", "1", "1d", 2, 0, 0), ("ad_id", "3", "1d", 4, 1, 0)], LONG)
    day = spark.createDataFrame([("ad_id", "1", "Bj1d", 0, 0, 3)], LONG)
    got = {(r.dim_key, r.window_tag): (r.imp, r.click, r.attr_install) for r in refresh.refresh_snapshot(snapshot, recount, day).collect()}
    assert got == {
        ("1", "1d"): (2, 0, 0),  # replaced as a whole
        ("1", "3d"): (12, 1, 0),  # grown
        ("1", "7d"): (2, 0, 0),  # created
        ("1", "14d"): (50, 5, 5),
        ("1", "Bj1d"): (0, 0, 3),
        ("2", "1d"): (7, 7, 7),  # no recent event: the old slot stays
        ("2", "Bj1d"): (0, 0, 6),
        ("3", "1d"): (4, 1, 0), ("3", "3d"): (4, 1, 0), ("3", "7d"): (4, 1, 0),
    }
    plan = refresh.refresh_snapshot(snapshot, recount, day)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_merge_rules(spark):
    c, n = "ad_package_category", "ad_package_name"
    day = spark.createDataFrame(
        [
            (c, "small", "7d", 5, 1, 0), (c, "big", "7d", 200, 20, 4), (c, "big", "30d", 999, 9, 9),
            (n, "few", "7d", 3, 1, 2), (n, "none", "7d", 400, 3, 0), (n, "some", "7d", 400, 3, 1), ("ad_id", "1", "7d", 1, 1, 1),
        ],
        LONG,
    )
    hourly = spark.createDataFrame(
        [(n, "some", "30d", 50, 1, 1), (n, "none", "30d", 50, 0, 7), (n, "new", "30d", 250, 2, 9), (n, "some", "7d", 1, 1, 1)], LONG
    )
    rules = SmoothingRules(category_min_imp=100, name_min_imp=100, name_floor_imp=50, imps_per_install=100)
    got = {r.dim_key: (r.imp, r.click, r.attr_install, r.day_cvr) for r in refresh.merge_smooth(day, hourly, rules).collect()}
    assert got == {
        "small": (205, 1, 4, 0.0),  # totals of all categories, clicks untouched
        "big": (200, 20, 4, 0.01),
        "few": (50, 1, 2, 0.01),
        "none": (450, 3, 4, 0.0),  # no day install: one per hundred impressions
        "some": (450, 4, 2, 0.01),
        "new": (250, 2, 2, None),  # only in the hourly input
    }


def test_wilson(spark):
    row = spark.createDataFrame([(3, 10), (0, 10), (10, 10), (0, 0)], "pos bigint, total bigint").select(
        refresh.wilson_lower_bound(F.col("pos"), F.col("total")).alias("w")
    )
    got = [r.w for r in row.collect()]

    def brute(p, n, z=2.0):
        p = p / n
        return (p + z * z / (2 * n) - z / (2 * n) * math.sqrt(4 * n * (1 - p) * p + z * z)) / (1 + z * z / n)

    assert got[:3] == pytest.approx([brute(3, 10), brute(0, 10), brute(10, 10)], abs=1e-12)
    assert got[3] is None


def test_local_day():
    assert local_day_hours(dt.datetime(2024, 1, 31, 0)) == ("2024013016", "2024013116")
    assert local_day_hours(dt.datetime(2024, 1, 31, 17)) == ("2024013116", "2024020116")


def test_local_day_installs(spark):
    rows = spark.createDataFrame([(1, "2024013015"), (1, "2024013016"), (1, "2024013115"), (2, "2024013116")], "ad_id bigint, hour string")
    got = counters.local_day_installs(rows, "2024013016", "2024013116").collect()
    assert [(r.window_tag, r.dim_key, r.imp, r.attr_install) for r in got] == [("Bj1d", "1", 0, 2)]
