"""Catalogue partitions, ordered files, published versions, bucketed stores and pairs of days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adfeat.operators import calibration as cal
from adfeat.operators import counters, samples
from adfeat.plans import hourly
from adfeat.sinks import export, ordered, publish
from adfeat.sources import catalogue, logs, stores
from registry import fixtures as fx

SF = "/root/testdata/sf0.001"


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_catalogue_hours_are_pruned_and_late_ones_appear(spark, tmp_path, rows_of):
    root = str(tmp_path / "hours")
    rows = spark.range(60).selectExpr("id", "concat('202401', lpad(id div 24 + 1, 2, '0'), lpad(id % 24, 2, '0')) AS hour")
    catalogue.create_hour_table(spark, "hours_t", "id BIGINT", root)
    late = F.col("hour") == "2024010205"
    catalogue.write_hours(rows.where(~late), root)
    hours = catalogue.hours_of(rows.where(~late))
    assert catalogue.scan_hours(spark, "hours_t").count() == 0  # written but not registered
    catalogue.register_hours(spark, "hours_t", hours)
    catalogue.register_hours(spark, "hours_t", hours)  # safe to repeat
    assert catalogue.scan_hours(spark, "hours_t").count() == 59
    catalogue.write_hours(rows.where(late), root)
    catalogue.register_hours(spark, "hours_t", ["2024010205"])
    assert rows_of(catalogue.scan_hours(spark, "hours_t").select("id", "hour")) == rows_of(rows)
    some = catalogue.scan_hours(spark, "hours_t", "2024010122", "2024010201")
    assert sorted(r.hour for r in some.collect()) == ["2024010122", "2024010123", "2024010200", "2024010201"]
    assert len(files(some)) == 4
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert logs.scan_table(spark, "hours_t", "20240102").count() == 24
    assert catalogue.hours_of(spark.createDataFrame([(None,)], "hour string")) == []


@pytest.mark.parametrize("lines", [1, 7, 1000])
def test_ordered_lines_over_files(spark, tmp_path, lines):
    path = str(tmp_path / "o")
    df = spark.range(50).selectExpr("id * 37 % 50 AS k", "concat('line ', id * 37 % 50) AS t").repartition(5)
    ordered.write_ordered(df, F.col("t"), ["k"], path, lines)
    got = sorted((r.position, r.value) for r in ordered.read_ordered(spark, path).collect())
    assert got == [(k, f"line {k}") for k in range(50)]
    assert len(list((tmp_path / "o" / "lines").glob("part=*"))) >= min(lines == 1 and 20 or 1, 50)
    empty = str(tmp_path / "none")
    ordered.write_ordered(df.limit(0), F.col("t"), ["k"], empty, lines)
    assert ordered.read_ordered(spark, empty).count() == 0


def test_calibration_model_file_keeps_its_order(spark, tmp_path):
    buckets = spark.createDataFrame([(i, 10, i // 3) for i in range(30)], cal.BLOCKS)
    model = cal.isotonic_model(buckets)
    ordered.write_calibration_model(model, str(tmp_path / "m"), 3)
    rows = sorted(ordered.read_calibration_model(spark, str(tmp_path / "m")).collect(), key=lambda r: r.position)
    assert [r.prate for r in rows] == sorted(r.prate for r in model.collect())
    assert {(r.bucket, r.rate) for r in rows} == {(r.bucket, r.rate) for r in model.collect()}


def test_a_refused_version_is_never_read(spark, tmp_path, rows_of):
    root = str(tmp_path / "p")
    good = spark.createDataFrame([("ad_id", "1", "7d", 5, 2, 1)], "dim_set string, dim_key string, window_tag string, imp long, click long, attr_install long")
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    with pytest.raises(publish.Refused) as refused:
        publish.publish(good.withColumn("click", F.lit(-1)), root)
    assert refused.value.bad.count() == 1
    with pytest.raises(FileNotFoundError):  # a first version that was refused leaves nothing to read
        publish.read_published(spark, root)
    assert publish.publish(good, root) == 1
    more = good.unionByName(good.withColumn("dim_key", F.lit("2")))
    with pytest.raises(publish.Refused):
        publish.publish(more.withColumn("window_tag", F.lit("99d")), root)
    assert rows_of(publish.read_published(spark, root)) == rows_of(good)
    assert publish.publish(more, root, partition_by=("dim_set",)) == 2
    assert publish.read_published(spark, root).count() == 2 and publish.read_published(spark, root, version=1).count() == 1
    entry = publish.current(spark, root)
    assert (entry.version, entry.n_rows) == (2, 2)
    back = publish.read_published(spark, root, more.schema).select(*more.columns)
    assert publish.verified(back, entry) and not publish.verified(back.limit(1), entry)
    assert not publish.verified(back.withColumn("imp", F.col("imp") + 1), entry)


def test_a_half_written_version_is_never_read(spark, tmp_path):
    root = str(tmp_path / "p")
    publish.publish(spark.range(3), root, check=lambda df: df.limit(0))

    def fails(df):
        raise RuntimeError("lost before the manifest was written")

    with pytest.raises(RuntimeError):
        publish.publish(spark.range(9), root, check=fails)
    assert publish.read_published(spark, root).count() == 3


def test_refresh_publishes_after_its_check(spark, tmp_path):
    root, columns = str(tmp_path), "requestid string, beyla_id string, country string, pos_id string, package_name string"
    shows = spark.createDataFrame([("r", "u", "EG", "", "app", "AD_CpiShow", "x", "1", "2", "2024013100")], f"{columns}, event_name string, ad_package_name string, ad_id string, c_id string, hour string")
    installs = spark.createDataFrame([("r", "u", "EG", "p", "app", "x", "1", "2", "2024013100")], f"{columns}, ad_package_name string, ad_id string, c_id string, hour string")
    export.write_hourly_tsv(shows, f"{root}/shows")
    export.write_hourly_tsv(installs, f"{root}/installs")
    day = "dim_set string, dim_key string, window_tag string, imp long, click long, attr_install long"
    snapshot = spark.createDataFrame([("ad_id", "1", "7d", 10, 3, 1)], day)
    now = dt.datetime(2024, 1, 31, 1)
    version = hourly.publish_refresh(spark, snapshot, f"{root}/shows", f"{root}/installs", f"{root}/fresh", now, "none")
    rows = {(r.dim_set, r.dim_key, r.window_tag): r.imp for r in publish.read_published(spark, f"{root}/fresh").collect()}
    assert version == 1 and rows[("ad_id", "1", "7d")] == 11
    with pytest.raises(publish.Refused):
        hourly.publish_refresh(spark, snapshot.withColumn("click", F.lit(2**40)), f"{root}/shows", f"{root}/installs", f"{root}/fresh", now, "none")
    assert publish.current(spark, f"{root}/fresh").version == 1


def test_lookups_do_not_shuffle_the_store(spark, tmp_path, rows_of):
    rows = counters.user_counter_rows(fx.accu(spark, SF, users=True))
    entries = export.user_counter_entries(rows, 0)
    entities = entries.select(F.substring_index("entity_key", ":", -1).alias("user_id"), F.col("value").alias("pb"))
    stores.write_entity_store(entities, "store_t", 8, str(tmp_path / "store"))
    users = spark.createDataFrame([("1",), ("1",), ("4",), ("none",), (None,)], "user_id string")
    got = stores.counters_of_users(users, "store_t")
    want = stores.counters_of_entities(entities.where(F.col("user_id").isin("1", "4")))
    assert rows_of(got) == rows_of(want) and not want.isEmpty()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stores.counters_of_users(users, "store_t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SelectedBucketsCount: 8 out of 8" in plan and "SortMergeJoin" in plan
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in lines[join:scan])


def test_pairs_of_days(spark, tmp_path):
    days = [f"2024010{k}" for k in range(1, 8)]
    features = spark.createDataFrame([(u, 10 * i + u, d) for i, d in enumerate(days) for u in (1, 2)], "user_id long, n long, dt string")
    features.write.partitionBy("dt").parquet(str(tmp_path / "f"))
    stored = spark.read.schema("user_id long, n long, dt string").parquet(str(tmp_path / "f"))
    labels = spark.createDataFrame([(1, 1, "20240103"), (2, 2, "20240106"), (3, 9, "20240106"), (4, 1, "20240101")], "i long, user_id long, dt string")
    paired = samples.pair_days(labels, stored, ["user_id"])
    got = {r.i: (r.dt, r.feature_dt, r.n) for r in paired.collect()}
    assert got == {1: ("20240103", "20240102", 11), 2: ("20240106", "20240105", 42), 3: ("20240106", "20240105", None), 4: ("20240101", "20231231", None)}
    assert "dynamicpruning" in paired._jdf.queryExecution().optimizedPlan().toString()
    read = samples.pair_days(labels, stored.withColumn("file", F.input_file_name()), ["user_id"], how="inner")
    assert {r.file.split("dt=")[1][:8] for r in read.collect()} == {"20240102", "20240105"}
    scans = paired._jdf.queryExecution().executedPlan()
    paired.collect()
    assert "dynamicpruningexpression" in scans.toString()


def test_feature_days_follow_the_label_day(spark):
    df = spark.sql("SELECT explode(array(date'2024-03-01', date'2024-01-01')) AS d")
    assert {str(r[0]) for r in df.select(samples.feature_date_of(F.col("d"))).collect()} == {"2024-02-29", "2023-12-31"}


def test_buckets_of_the_store_grow_with_its_input(spark, monkeypatch):
    from registry.queries import entity_store_lookup

    monkeypatch.setattr(counters, "TASK_ROWS", 200)
    tasks = counters.user_tasks(spark, fx.table(spark, SF, "lineitem").count())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a broadcast of the requests would need no buckets
    try:
        plan = entity_store_lookup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert tasks > 8 and f"SelectedBucketsCount: {tasks} out of {tasks}" in plan


def test_texts_of_the_store_are_not_shuffled(spark, monkeypatch, tmp_path):
    from registry import queries

    frame = type(spark.range(0))
    calls, folder, deal = [], tmp_path / "shared", frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *keys: calls.append(keys) or deal(self, n, *keys))
    monkeypatch.setattr(fx, "scratch", lambda _: str(folder))
    found = queries.entity_store_lookup(spark, SF)
    files = [f.name.split("_")[-1].split(".")[0] for f in (folder / "store").glob("part-*.parquet")]
    assert calls.count(("user_id",)) == 1  # the narrow input rows, before they become texts
    assert len(files) == len(set(files)) > 1  # each bucket lies in one file
    assert found.count() > 0


def test_store_of_rows_that_lie_elsewhere(spark, tmp_path):
    pb = '{"storeUserCounter":{"user_id#%s":{"countFeatures1d":{"imp":%d}}}}'
    users = [None, "a", "a", "b", "c", "d"]
    entities = spark.createDataFrame([(u, pb % (u, k + 1)) for k, u in enumerate(users)], "user_id string, pb string").repartition(5)
    asked = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "user_id string")
    got = []
    for dealt in (False, True):
        stores.write_entity_store(entities, f"lies_{dealt}", 8, str(tmp_path / str(dealt)), dealt=dealt)
        got.append(sorted((r.user_id, r.imp) for r in stores.counters_of_users(asked, f"lies_{dealt}").collect()))
    assert got[0] == got[1] == [("a", 2), ("a", 3), ("c", 5)]
