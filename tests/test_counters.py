import json

import pytest
from pyspark.sql import functions as F

from adfeat.config import MAIN, NATION, DimSet, dim_sets
from adfeat.functions.cells import window_sums
from adfeat.operators import counters
from adfeat.sources.stores import counters_of_documents, counters_of_entities

ACCU = (
    "window_tag string, nation string, user_id string, package_name string, pos_id string, ad_id bigint, "
    "ad_package_name string, ad_package_category string, c_id bigint, imp bigint, click bigint, attr_install bigint"
)


def accu(spark):
    return spark.createDataFrame(
        [
            ("7d", "EG", "u1", "a", "p", 1, "Brand#1", "G", 10, 5, 1, 0),
            ("7d", "EG", "u1", "a", "p", 1, "Brand#1", "G", 10, 2, None, 0),
            ("7d", "ID", "u2", "b", None, 1, "Brand#1", "G", None, 3, 0, -4),
            ("1d", "EG", "u1", "a", "p", 2, "Brand#2", "H", 10, 0, 0, 0),
        ],
        ACCU,
    )


def find(rows, **want):
    return [r for r in rows if all(r[k] == v for k, v in want.items())]


def test_slot_names():
    assert DimSet("pos_id#ad_package_name").slot == "posIdAdPackageName"
    assert DimSet("user_id").slot == "userId"


def test_ad_counters(spark):
    rows = counters.ad_counters(accu(spark)).collect()
    (total,) = find(rows, dim_set="ad_id", dim_key="1", window_tag="7d")
    assert (total.imp, total.click, total.attr_install) == (10, 1, 0)  # a negative total is no count
    assert find(rows, dim_set="c_id", dim_key="None", window_tag="7d")[0].imp == 3
    assert find(rows, dim_set="pos_id#c_id", dim_key="None#None")[0].imp == 3
    assert find(rows, dim_set="package_name#ad_package_name", dim_key="a#Brand#1")[0].imp == 7
    assert find(rows, dim_set="ad_id", dim_key="2", window_tag="1d")[0].imp == 0  # all-zero keys stay
    for s in MAIN.ad_sets:
        assert sum(r.imp for r in find(rows, dim_set=s.name)) == 10


def test_nation_counters(spark):
    rows = counters.ad_counters(accu(spark), NATION).collect()
    assert {r.dim_set for r in rows} == {s.name for s in NATION.ad_sets}
    assert find(rows, nation="EG", dim_set="ad_id", dim_key="1")[0].imp == 7
    docs = counters.counter_documents(counters.ad_counters(accu(spark), NATION), NATION, ("nation",)).collect()
    assert json.loads({d.counter_key: d.value for d in docs}["ID#ad_id#1"]) == {"countFeatures7d": {"imp": 3}}


def test_user_counters(spark):
    rows = counters.user_counters(accu(spark)).collect()
    assert find(rows, user_id="u1", dim_set="user_id#pos_id#ad_package_name", dim_key="u1#p#Brand#1")[0].imp == 7
    for s in MAIN.user_sets:
        assert sum(r.imp for r in find(rows, dim_set=s.name)) == 10


def test_non_ascii_dimensions_left_out(spark):
    df = accu(spark).replace({"Brand#2": "Café"}, subset="ad_package_name")
    names = {r.dim_key for r in counters.user_counters(df, NATION).collect()}
    assert not any("Café" in n for n in names)
    assert any("Café" in r.dim_key for r in counters.user_counters(df).collect())


def test_documents(spark):
    docs = {r.counter_key: json.loads(r.value) for r in counters.counter_documents(counters.ad_counters(accu(spark))).collect()}
    assert docs["ad_id#1"] == {"countFeatures7d": {"imp": 10, "click": 1}}
    assert docs["ad_id#2"] == {"countFeatures1d": {}}


def test_documents_read_back(spark, rows_of):
    for variant, by in ((MAIN, ()), (NATION, ("nation",))):
        long = counters.ad_counters(accu(spark), variant)
        back = counters_of_documents(counters.counter_documents(long, variant, by), variant)
        cols = [*by, "dim_set", "dim_key", "window_tag", "imp", "click", "attr_install"]
        assert rows_of(back.select(cols)) == rows_of(long.select(cols))


def test_entities_read_back(spark, rows_of):
    from adfeat.sinks.export import user_counter_entries

    long = counters.user_counters(accu(spark))
    entries = user_counter_entries(long, 0).selectExpr("substring_index(entity_key, ':', -1) AS user_id", "value AS pb")
    cols = ["user_id", "dim_set", "dim_key", "window_tag", "imp", "click", "attr_install"]
    assert rows_of(counters_of_entities(entries).select(cols)) == rows_of(long.select(cols))


def test_cells_add_up_rows(spark, rows_of):
    summed = counters.counter_cells(counters.user_counters(accu(spark)), by=("user_id",))
    assert rows_of(counters.counter_cells(counters.user_counter_rows(accu(spark)), by=("user_id",))) == rows_of(summed)


def test_unknown_and_null_windows_stop_the_job(spark):
    for tag in (None, "2d"):
        rows = spark.createDataFrame([(tag, 1, 1, 1)], "window_tag string, imp bigint, click bigint, attr_install bigint")
        with pytest.raises(Exception, match=f"unknown window tag: {tag or 'null'}"):
            rows.agg(*window_sums()).collect()


def test_event_counters(spark):
    dims = "package_name string, pos_id string, ad_id string, ad_package_name string, c_id string"
    shows = spark.createDataFrame(
        [("a", "p", "1", "x", "9", "AD_CpiShow"), ("a", "p", "1", "x", "9", "AD_CpiClick"), ("a", "p", "1", "x", "9", "Other")],
        dims + ", event_name string",
    )
    installs = spark.createDataFrame([("a", "p", "1", "x", "9"), ("a", None, "1", "x", "9")], dims)
    rows = counters.event_counters(shows, installs).collect()
    assert len({r.dim_set for r in rows}) == 9
    (r,) = find(rows, dim_set="ad_id")
    assert (r.window_tag, r.dim_key, r.imp, r.click, r.attr_install) == ("1d", "1", 1, 1, 2)
    assert {r.dim_key: r.attr_install for r in find(rows, dim_set="pos_id#ad_id")} == {"p#1": 1, "None#1": 1}


def test_plan_stays_in_the_jvm(spark):
    plan = counters.ad_counters(accu(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Python" not in plan and "SinglePartition" not in plan
    assert plan.count("Exchange") == 1


def test_custom_sets(spark):
    rows = counters.rollup(accu(spark), dim_sets(["ad_id"]), ["window_tag"], counters.measure_sums()).collect()
    assert {(r.window_tag, r.dim_key): r.imp for r in rows} == {("7d", "1"): 10, ("1d", "2"): 0}


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


def test_user_counters_shuffle_narrow_rows_once(spark, rows_of):
    from adfeat.sinks.export import user_counter_entries

    rows = accu(spark).unionByName(accu(spark).withColumn("user_id", F.lit(None).cast("string")))
    for variant in (MAIN, NATION):
        summed = counters.user_counters(rows, variant, tasks=3)
        (line,) = _exchanges(summed)
        assert "hashpartitioning(user_id" in line and ", 3)" in line
        want = counters.user_counter_rows(rows, variant).groupBy("user_id", "window_tag", "dim_set", "dim_key").agg(*counters.measure_sums())
        assert rows_of(summed) == rows_of(want)
    entries = user_counter_entries(counters.user_counter_rows(counters.by_user(rows)), 0)
    assert len(_exchanges(entries)) == 1
    assert rows_of(entries) == rows_of(user_counter_entries(counters.user_counter_rows(rows), 0))


def test_tasks_of_user_counters_grow_with_the_rows(spark):
    assert counters.user_tasks(spark, 0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert counters.user_tasks(spark, 216_000_001) == 2161
