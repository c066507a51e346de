import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adfeat.operators import features
from adfeat.plans import daily, hourly, training
from registry import fixtures as fx
from registry import queries as q

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 31)


def test_log_hour(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    fx.ads_lines(spark, SF, "rec_ads").write.text(f"{raw}/2024/01/31/13")
    spark.sql(f"CREATE TABLE rec_hours (value STRING, dt STRING, hour STRING) USING text PARTITIONED BY (dt, hour) LOCATION '{out}'")
    hourly.flatten_log_hour(spark, "rec", raw, out, "2024013105", "rec_hours")
    assert spark.table("rec_hours").count() == q.flatten_rec_log(spark, SF).count()


def test_recent_events_into_the_snapshot(spark, tmp_path):
    cpi, installs, shows_out, installs_out = (str(tmp_path / n) for n in ("cpi", "installs", "shows_out", "installs_out"))
    parts = [F.substring("hour", 1, 8).alias("dt"), F.substring("hour", 9, 2).alias("hh")]
    days = "2024013"  # the two days that hold the newest 24 hours
    log = fx.cpi_log(spark, SF).where(F.col("hour").startswith(days)).select("*", *parts).drop("hour").withColumnRenamed("hh", "hour")
    log.write.partitionBy("dt", "hour").parquet(cpi)
    post = fx.install_log(spark, SF).where(F.col("hour").startswith(days)).select("*", *parts).drop("hour").withColumnRenamed("hh", "hour")
    post.withColumn("flag", F.lit("postback")).write.partitionBy("dt", "hour", "flag").parquet(installs)
    hours = sorted({r.dt + r.hour for r in log.select("dt", "hour").distinct().collect()})
    post_hours = sorted({r.dt + r.hour for r in post.select("dt", "hour").distinct().collect()})
    packages = (*fx.PACKAGES, fx.EXCLUDED_PACKAGE)
    for h in hours[-3:]:
        hourly.project_imp_click_hour(spark, cpi, shows_out, h, fx.PACKAGES)
    for h in post_hours[-3:]:
        hourly.project_install_hour(spark, installs, installs_out, h, packages, "postback")
    shows, got = hourly.recent_events(spark, shows_out, installs_out, fx.EXCLUDED_PACKAGE)
    assert set(r.hour for r in shows.select("hour").distinct().collect()) <= set(hours[-3:])
    assert got.where(F.col("package_name") == fx.EXCLUDED_PACKAGE).count() == 0

    snap_root = str(tmp_path / "snap")
    daily.build_ad_counters(fx.accu(spark, SF), snap_root, "20240130")
    snapshot = spark.read.parquet(f"{snap_root}/dt=20240130")
    bad = hourly.refresh_counters_hour(spark, snapshot, shows_out, installs_out, str(tmp_path / "fresh"), NOW, fx.EXCLUDED_PACKAGE)
    assert bad.count() == 0
    fresh = spark.read.parquet(str(tmp_path / "fresh"))
    total = lambda df: df.where("dim_set = 'ad_id' AND window_tag = '7d'").agg(F.sum("imp")).first()[0]
    assert total(fresh) == total(snapshot) + shows.where("event_name = 'AD_CpiShow'").count()


def test_daily_and_training(spark, tmp_path):
    root = str(tmp_path)
    accu = fx.accu(spark, SF, users=True)
    daily.build_ad_counters(accu, f"{root}/ad", "20240130")
    daily.build_user_counters(accu, f"{root}/user", "20240130")
    daily.build_user_profiles(fx.user_base(spark, SF), fx.user_behaviour(spark, SF), fx.allowed_apps(spark, SF), f"{root}/profile", "20240130")
    daily.build_ad_info(fx.app_category(spark, SF), fx.creatives(spark, SF), fx.campaigns(spark, SF), f"{root}/info", "20240130", NOW)
    ad, user, prof, info = (spark.read.parquet(f"{root}/{n}/dt=20240130") for n in ("ad", "user", "profile", "info"))
    assert info.count() == q.adinfo_overlay(spark, SF).count()
    daily.merge_counters(spark, ad, ad, f"{root}/merged", "20240130")
    daily.publish_users(user, prof, f"{root}/kv", "20240130", 0)
    assert spark.read.parquet(f"{root}/kv/user_profile").count() == prof.count()

    labels = fx.labels(spark, SF)
    with pytest.raises(ValueError):
        training.build_lookup_samples(labels, ad, user, prof, f"{root}/bad", "2024-01-31", "2024-01-31")
    training.build_lookup_samples(labels, ad, user, prof, f"{root}/samples", "2024-01-30", "2024-01-31")
    lines = spark.read.text(f"{root}/samples")
    assert lines.count() == labels.count()
    assert set(json.loads(lines.first().value)) == {"label", "feature"}

    doc = F.from_json("value", "label struct<click:int, attrInstall:int>, feature struct<context: struct<posId:string, clientIp:string>>")
    extract = features.column_extractor(
        doc["label"]["click"], doc["label"]["attrInstall"],
        {"ctx_pos": doc["feature"]["context"]["posId"], "ctx_ip": doc["feature"]["context"]["clientIp"]},
    )
    training.analyse_features(spark, f"{root}/samples", extract, f"{root}/analysis")
    mi = {r.value.split("\t")[0]: r.value.split("\t") for r in spark.read.text(f"{root}/analysis/mi_ctr").collect()}
    counts = features.feature_label_counts(lines, extract)
    assert {k: float(v[2]) for k, v in mi.items()} == pytest.approx({r.feature: r.mi for r in features.mutual_information(counts).collect()})
    index = sorted(r.value for r in spark.read.text(f"{root}/analysis/index").collect())
    assert index[0] == "ctx_ip\t0\t100000\tint\t0\t0\t0"

    training.encode_samples(spark, f"{root}/samples", f"{root}/encoded")
    decoded = spark.read.text(f"{root}/encoded").select(F.unbase64("value").cast("string").alias("value"))
    assert decoded.exceptAll(lines).count() == 0 and decoded.count() == lines.count()


def test_logged_samples(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "features")
    fx.logged_lines(spark, SF).write.text(f"{raw}/2024/01/31/13")
    hourly.flatten_log_hour(spark, "train_feature", raw, out, "2024013105")
    training.build_logged_samples(spark, q._sample_labels(spark, SF), out, "20240131", str(tmp_path / "samples"))
    want = q.train_sample_logged(spark, SF).select("sample").withColumnRenamed("sample", "value")
    got = spark.read.text(str(tmp_path / "samples"))
    parse = lambda df: sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in df.collect())
    assert parse(got) == parse(want)


def test_calibration(spark, tmp_path):
    rows = fx.rate_rows(spark, SF)
    rate = rows.select("beyla_id", F.lit("x").alias("ad_package_name"), "ad_id", "c_id", "pctr", "pcvr", F.col("bid_price").alias("bid"), "is_click", "is_attr_install")
    rate.write.csv(str(tmp_path / "rates"), sep="\t")
    training.train_calibration(spark, str(tmp_path / "rates"), str(tmp_path / "model"))
    got = training.evaluate_calibration(spark, str(tmp_path / "rates"), str(tmp_path / "model")).first()
    want = q.calibration_bias(spark, SF).first()
    assert (round(got.mean_score, 9), round(got.mean_label, 9)) == (want.mean_score, want.mean_label)

    ecpm = rows.select("beyla_id", F.lit("x").alias("p"), "ad_id", "c_id", "pctcvr", "is_click", "is_attr_install", "bid_price")
    ecpm.write.csv(str(tmp_path / "ecpm"), sep="\t")
    assert round(training.evaluate_ecpm(spark, str(tmp_path / "ecpm")).first().auc, 9) == q.bid_weighted_auc(spark, SF).first().auc
