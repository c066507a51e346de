import json

import pytest
from pyspark.sql import functions as F

import jobs
from registry import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """Warehouse tables under their own column names, partitioned by day."""
    accu = fx.accu(spark, SF, users=True).withColumnsRenamed({
        "user_id": "beyla_id", "window_tag": "tag", "imp": "imp_sum", "click": "click_sum", "nation": "req_country",
    })
    for day in ("20240130", "20240131"):
        accu.withColumnRenamed("attr_install", "attr_install_sum").withColumn("dt", F.lit(day)).write.mode("append").partitionBy("dt").saveAsTable("accu")
    accu.withColumnRenamed("attr_install", "install_sum").withColumn("dt", F.lit("20240130")).write.partitionBy("dt").saveAsTable("accu_nation")
    labels = fx.labels(spark, SF).withColumnsRenamed({"user_id": "beyla_id", "nation": "req_country"}).withColumn("dt", F.lit("20240131"))
    labels.write.partitionBy("dt").saveAsTable("label_rows")
    labels.withColumnRenamed("is_attr_install", "is_install").write.partitionBy("dt").saveAsTable("label_rows_nation")
    fx.user_base(spark, SF).withColumnRenamed("user_id", "beyla_id").write.saveAsTable("bases")
    fx.user_behaviour(spark, SF).withColumnRenamed("user_id", "beyla_id").withColumn("dt", F.lit("20240130")).write.partitionBy("dt").saveAsTable("acts")


def test_samples_from_tables(spark, tables, tmp_path, rows_of):
    r = str(tmp_path)
    (tmp_path / "apps").write_text("\n".join(fx.ALLOWED_APPS))
    jobs.main(["ad-counters", "--table", "accu", "--day", "20240130", "--root", f"{r}/ad"])
    jobs.main(["user-counters", "--table", "accu", "--day", "20240130", "--root", f"{r}/user"])
    jobs.main(["profiles", "--base", "bases", "--behaviour", "acts", "--allow-list", f"{r}/apps", "--day", "20240130", "--root", f"{r}/profile"])
    samples = ["samples", "--labels", "label_rows", "--ad-counters", f"{r}/ad/dt=20240130", "--user-counters", f"{r}/user/dt=20240130",
               "--profiles", f"{r}/profile/dt=20240130", "--label-day", "20240131", "--out", f"{r}/samples", "--packages", ",".join(fx.PACKAGES)]
    with pytest.raises(ValueError):
        jobs.main([*samples, "--feature-day", "20240131"])
    jobs.main(samples)  # by default the features of the day before
    from registry.queries import train_sample_lookup

    assert rows_of(spark.read.text(f"{r}/samples")) == rows_of(train_sample_lookup(spark, SF).select("sample"))
    jobs.main(["publish", "--user-counters", f"{r}/user/dt=20240130", "--profiles", f"{r}/profile/dt=20240130", "--day", "20240130",
               "--root", f"{r}/kv", "--published-at", "5"])
    assert spark.read.parquet(f"{r}/kv/user_counter").first().expire_at == 5 + 259200
    jobs.main(["merge", "--snapshot", f"{r}/ad/dt=20240130", "--hourly", f"{r}/ad/dt=20240130", "--day", "20240130", "--root", f"{r}/merged"])
    assert spark.read.parquet(f"{r}/merged").select("dim_set").distinct().count() == 2
    jobs.main(["merge-published", "--snapshot", f"{r}/ad/dt=20240130", "--hourly", f"{r}/ad/dt=20240130", "--root", f"{r}/published"])
    from adfeat.sinks.publish import current, read_published

    table, documents = read_published(spark, f"{r}/published/counters"), read_published(spark, f"{r}/published/documents")
    assert table.count() == documents.count() == spark.read.parquet(f"{r}/merged").count()
    spark.read.parquet(f"{r}/ad/dt=20240130").withColumn("imp", F.lit(2**40)).write.parquet(f"{r}/broken")
    with pytest.raises(SystemExit, match="not published"):
        jobs.main(["merge-published", "--snapshot", f"{r}/broken", "--hourly", f"{r}/broken", "--root", f"{r}/published"])
    assert current(spark, f"{r}/published/counters").version == current(spark, f"{r}/published/documents").version == 1

    jobs.main(["analyse-features", "--samples", f"{r}/samples", "--features", "ctx_pos=feature.context.posId,ad=feature.adData.adInfo.adId", "--out", f"{r}/analysis"])
    assert {x.value.split("\t")[0] for x in spark.read.text(f"{r}/analysis/mi_ctr").collect()} == {"ctx_pos", "ad"}


def test_nation_variant(spark, tables, tmp_path, rows_of):
    r = str(tmp_path)
    common = ["--day", "20240130", "--variant", "nation"]
    jobs.main(["ad-counters", "--table", "accu_nation", "--root", f"{r}/ad", *common])
    jobs.main(["user-counters", "--table", "accu_nation", "--root", f"{r}/user", "--tag", "3d", "--nation", "EG", *common])
    jobs.main(["profiles", "--base", "bases", "--behaviour", "acts", "--root", f"{r}/profile", *common])
    jobs.main(["samples", "--labels", "label_rows_nation", "--ad-counters", f"{r}/ad/dt=20240130", "--user-counters", f"{r}/user/dt=20240130",
               "--profiles", f"{r}/profile/dt=20240130", "--label-day", "20240131", "--feature-day", "20240130", "--out", f"{r}/samples",
               "--nation", "EG", "--variant", "nation"])
    from registry.queries import train_sample_nation

    got = rows_of(spark.read.text(f"{r}/samples"))
    assert got == rows_of(train_sample_nation(spark, SF).select("sample"))
    assert json.loads(got[0][0])["feature"]["context"]["nation"] == "EG"


def test_ad_info(spark, tmp_path):
    fx.app_category(spark, SF).write.saveAsTable("apps")
    fx.creatives(spark, SF).write.saveAsTable("creatives")
    fx.campaigns(spark, SF).write.saveAsTable("campaigns")
    jobs.main(["ad-info", "--apps", "apps", "--creatives", "creatives", "--campaigns", "campaigns", "--day", "20240131",
               "--root", str(tmp_path), "--as-of", "2024-01-31 00:00:00"])
    from registry.queries import adinfo_overlay

    assert spark.read.parquet(str(tmp_path)).drop("dt").exceptAll(adinfo_overlay(spark, SF)).isEmpty()


def test_refresh_from_the_newest_snapshot(spark, tmp_path):
    from adfeat.sinks.export import write_hourly_tsv
    from adfeat.sinks.publish import read_published

    r, ids = str(tmp_path), "requestid string, beyla_id string, country string, pos_id string, package_name string"
    counts = "dim_set string, dim_key string, window_tag string, imp long, click long, attr_install long"
    for day, imp in (("20240129", 1), ("20240130", 10)):
        spark.createDataFrame([("ad_id", "1", "7d", imp, 0, 0)], counts).write.parquet(f"{r}/ad/dt={day}")
    write_hourly_tsv(spark.createDataFrame([("r", "u", "EG", "p", "app", "AD_CpiShow", "x", "1", "2", "2024013100")], f"{ids}, event_name string, ad_package_name string, ad_id string, c_id string, hour string"), f"{r}/shows")
    write_hourly_tsv(spark.createDataFrame([("r", "u", "EG", "p", "app", "x", "1", "2", "2024013100")], f"{ids}, ad_package_name string, ad_id string, c_id string, hour string"), f"{r}/installs")
    jobs.main(["refresh-published", "--snapshot-root", f"{r}/ad", "--imp-click", f"{r}/shows", "--install", f"{r}/installs", "--root", f"{r}/fresh",
               "--now", "2024013101", "--exclude", "none"])
    rows = {(x.dim_set, x.dim_key, x.window_tag): x.imp for x in read_published(spark, f"{r}/fresh").collect()}
    assert rows[("ad_id", "1", "7d")] == 11


def test_stream_of_message_files(spark, tmp_path):
    message = {"sub_pf": "cpi", "event_name": "AD_CpiShow", "package_name": "app", "pos_id": "p", "beyla_id": "u",
               "params": [{"ad_package_name": "x", "campaign_id": 4, "c_id": 3}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(json.dumps({"message": json.dumps(message)}) + "\n{broken\n")
    job = ["stream-events", "--packages", "app", "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "c")]
    jobs.main([*job, "--messages", str(tmp_path / "in")])
    jobs.main([*job, "--messages", str(tmp_path / "in")])
    assert [x.value for x in spark.read.text(str(tmp_path / "out")).collect()] == ["AD_CpiShow\tu\tapp\tp\tx\t4\t3"]
    with pytest.raises(SystemExit):
        jobs.main(job)


def test_unknown_job():
    with pytest.raises(SystemExit):
        jobs.main(["no-such-job"])
