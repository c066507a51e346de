import json

import pytest
from pyspark.sql import functions as F

from adfeat import schemas
from adfeat.operators import counters
from adfeat.sinks import export
from adfeat.sources import logs, stores


def test_hour_lines(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([('{"a":1}',)], "value string")
    df.write.text(f"{root}/datepart=20240201/hour=04")
    df.union(df).write.text(f"{root}/2024/02/01/04")
    assert logs.read_hour_lines(spark, root, "2024013120").count() == 1
    assert logs.read_hour_lines(spark, root, "2024013120", layout=logs.PATH_LAYOUT).count() == 2


def test_write_hour_lines(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([(1, None)], "ad_id bigint, feature string")
    export.write_hour_lines(df, root, "2024013105")
    (line,) = spark.read.text(f"{root}/dt=20240131/hour=05").collect()
    assert json.loads(line.value) == {"ad_id": 1, "feature": None}
    with pytest.raises(Exception, match="already exists"):
        export.write_hour_lines(df, root, "2024013105")
    export.write_hour_lines(df, root, "2024013106")
    back = logs.read_day_json(spark, root, "20240131", schemas.TRAIN_FEATURE)
    assert back.count() == 2 and back.select("ad_id").distinct().count() == 1


def test_read_hour_table(spark, tmp_path):
    root = str(tmp_path / "log")
    rows = [(1, "20240131", "05", "a"), (2, "20240131", "06", "a"), (3, "20240131", "05", "b")]
    spark.createDataFrame(rows, "x int, dt string, hour string, flag string").write.partitionBy("dt", "hour", "flag").parquet(root)
    df = logs.read_hour_table(spark, root, "2024013105", flag="a")
    assert [r.x for r in df.collect()] == [1]
    assert set(df.columns) == {"x", "dt", "hour", "flag"}
    assert len(df.inputFiles()) == 1


def test_latest_partitions_prune(spark, tmp_path):
    root = str(tmp_path / "snap")
    spark.createDataFrame([(i, h) for i, h in enumerate(["01", "03", "03", "07", "08"])], "x int, hour string").write.partitionBy("hour").parquet(root)
    df = spark.read.parquet(root)
    assert sorted(r.x for r in logs.latest_snapshot(df, "hour").collect()) == [4]
    last = logs.last_partitions(df, 3)
    assert sorted(r.x for r in last.collect()) == [1, 2, 3, 4]  # existing partitions, gaps not counted
    assert logs.last_partitions(df, 24).count() == 5
    listed = logs.last_partitions(df.withColumn("hour", F.format_string("%02d", "hour").cast("int")), 2, values=logs.partition_values(spark, root))
    assert sorted(r.x for r in listed.collect()) == [3, 4]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan and "Subquery" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_tsv(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("r", None, 'quo"te', "é")], "a string, b string, c string, d string")
    export.write_tsv(df, path)
    assert [r.value for r in spark.read.text(path).collect()] == ['r\tNone\tquo"te\té']
    assert tuple(stores.read_tsv(spark, path, "a string, b string, c string, d string").first()) == ("r", "None", 'quo"te', "é")
    for wrong in ("a string, b string, c string", "a string, b string, c string, d string, e string", "a int, b string, c string, d string"):
        with pytest.raises(Exception):
            stores.read_tsv(spark, path, wrong).collect()


def test_scan_table(spark):
    spark.sql("CREATE TABLE scan_me (x INT, dt STRING) USING parquet PARTITIONED BY (dt)")
    spark.sql("INSERT INTO scan_me VALUES (1, '20240101'), (2, '20240102')")
    assert [r.x for r in logs.scan_table(spark, "scan_me", "20240102").collect()] == [2]
    assert logs.scan_table(spark, "scan_me").count() == 2


def test_register_hour(spark, tmp_path):
    root = str(tmp_path / "log")
    spark.sql(f"CREATE TABLE hours (value STRING, dt STRING, hour STRING) USING text PARTITIONED BY (dt, hour) LOCATION '{root}'")
    df = spark.createDataFrame([("x",)], "value string")
    export.write_hour_lines(df, root, "2024013105")
    for _ in range(2):
        export.register_hour(spark, "hours", "2024013105", f"{root}/dt=20240131/hour=05")
    assert [tuple(r) for r in spark.table("hours").collect()] == [("x", "20240131", "05")]


def test_entities(spark, tmp_path):
    path = str(tmp_path / "e")
    odd = 'u}{"\\\té'
    rows = spark.createDataFrame([(odd, '{"userBase":{"city":"São"},"n":[1,2]}')], "user_id string, value string")
    export.entity_lines(rows).write.text(path)
    (back,) = stores.read_entities(spark, path).collect()
    assert back.user_id == odd and json.loads(back.pb) == {"userBase": {"city": "São"}, "n": [1, 2]}


def test_allow_list_and_model(spark, tmp_path):
    (tmp_path / "apps").write_text("a\nb\na\n")
    assert sorted(r.app for r in stores.read_allow_list(spark, str(tmp_path / "apps")).collect()) == ["a", "b"]
    model = spark.createDataFrame([(7, 3, 1, 0.0007, 1 / 3), (2, 5, 1, 0.0002, 0.2)], "bucket bigint, n bigint, clicks bigint, prate double, rate double")
    export.calibration_model_lines(model).write.text(str(tmp_path / "model"))
    text = spark.read.text(str(tmp_path / "model")).collect()
    assert [r.value.split(" ")[0] for r in text] == ["2", "7"]
    back = stores.read_calibration_model(spark, str(tmp_path / "model")).collect()
    assert [(r.bucket, r.prate, r.rate) for r in back] == [(2, 0.0002, 0.2), (7, 0.0007, 1 / 3)]


LONG = "user_id string, dim_set string, dim_key string, window_tag string, imp bigint, click bigint, attr_install bigint"


def test_counter_entries_in_parts_have_keys_of_their_own(spark):
    rows = [("big", "user_id#ad_id", f"big#{i}", "7d", 1, 0, 0) for i in range(50)] + [("small", "user_id", "small", "7d", 2, 0, 1)]
    counters = spark.createDataFrame(rows, LONG)
    whole = export.user_counter_entries(counters, 1000).collect()
    assert sorted((e.entity_key, e.part) for e in whole) == [("nt:ads:user_counter:big", 0), ("nt:ads:user_counter:small", 0)]
    small = next(e for e in whole if e.entity_key.endswith("small"))
    assert json.loads(small.value) == {"storeUserCounter": {"user_id#small": {"countFeatures7d": {"imp": 2, "attrInstall": 1}}}}
    assert small.expire_at == 1000 + 259200
    entries = export.user_counter_entries(counters, 1000, parts=4)
    keys = [e.entity_key for e in entries.collect()]
    assert len(keys) == len(set(keys)) and all(k.split("#")[-1] in "0123" for k in keys)
    found = stores.lookup_users(spark.createDataFrame([("big",), ("x",)], "user_id string"), entries, parts=4).collect()
    big = [json.loads(r.value)["storeUserCounter"] for r in found if r.user_id == "big" and r.value]
    assert sorted(k for b in big for k in b) == sorted(f"user_id#ad_id#big#{i}" for i in range(50))
    assert [r.value for r in found if r.user_id == "x"] == [None] * 4


def test_lookup_keeps_every_request(spark):
    entries = spark.createDataFrame([("nt:ads:user_counter:u", 0, "v")], "entity_key string, part int, value string")
    requests = spark.createDataFrame([("u",), ("u",), ("x",), (None,)], "user_id string")
    got = stores.lookup_users(requests, entries, hot_rows=1).collect()
    assert sorted((str(r.user_id), str(r.value)) for r in got) == [("None", "None"), ("u", "v"), ("u", "v"), ("x", "None")]


def test_publish_reaches_every_row(spark, tmp_path):
    entries = spark.createDataFrame([(f"k{i}", 0, "v", 1) for i in range(20)], "entity_key string, part int, value string, expire_at bigint")
    seen = spark.sparkContext.accumulator(0)
    export.publish_entries(entries, lambda rows: seen.add(sum(1 for _ in rows)), partitions=4)
    assert seen.value == 20


def test_invalid_counters(spark):
    rows = [("u", "s", k, w, imp, 0, inst) for k, w, imp, inst in [("ok", "7d", 1, 1), ("tag", "8d", 1, 1), ("null", None, 1, 1), ("big", "7d", 2**31, 1), ("edge", "7d", 2**31 - 1, 0), ("neg", "1d", 1, -1)]]
    got = {r.dim_key: r.reason for r in export.invalid_counters(spark.createDataFrame(rows, LONG)).collect()}
    assert got == {"tag": "window_tag", "null": "window_tag", "big": "imp", "neg": "attr_install"}


def test_manifest_ignores_order(spark):
    df = spark.createDataFrame([(str(i),) for i in range(100)], "value string")
    a = export.manifest(df).first()
    assert a == export.manifest(df.orderBy(F.desc("value")).repartition(5)).first()
    assert a.n_rows == 100 and a.checksum != export.manifest(df.where("value <> '7'")).first().checksum


def test_snapshot_by_set(spark, tmp_path):
    rows = spark.createDataFrame([("ad_id", "1", "7d", 1, 0, 0), ("c_id", "1", "7d", 1, 0, 0)], LONG.split(", ", 1)[1])
    export.write_snapshot(rows, str(tmp_path), "20240131", by_set=True)
    back = stores.read_counters(spark, str(tmp_path / "dt=20240131"))
    assert counters.counter_cells(back).count() == 2
    assert (tmp_path / "dt=20240131" / "dim_set=ad_id").is_dir()


def test_empty_text_survives_a_tsv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("", "a", 1), ("x", "", 2)], "pos_id string, ad_id string, imp long")
    export.write_tsv(rows, str(tmp_path / "lines"))
    back = stores.read_tsv(spark, str(tmp_path / "lines"), "pos_id string, ad_id string, imp long")
    assert sorted(map(tuple, back.collect())) == [("", "a", 1), ("x", "", 2)]
