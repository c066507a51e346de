import json

import pytest
from pyspark.sql import functions as F

from adfeat import schemas
from adfeat.functions.jsontext import malformed_lines
from adfeat.functions.timing import shift_hour, shifted_partition
from adfeat.operators import flatten, project


def lines(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def mixer(**change):
    ad = {"app_id": "a", "camp_id": 5, "creative_id": "c", "ecpm": 1.5, "model_spec": "m"}
    doc = {"request_id": "r", "user_id": "u", "pos_id": "p", "timestamp": 7, "hit_exp": ["x", "y"], "model_results": {"res_model": [ad, ad]}}
    doc.update(change)
    return doc


def test_mixer_log(spark):
    rows = flatten.flatten_mixer_log(lines(spark, mixer(), mixer(hit_exp=None), mixer(model_results=None), {"request_id": "x"})).collect()
    assert len(rows) == 4
    assert tuple(rows[0]) == ("r", "x,y", "u", "p", 7, "a", "5", "c", 1.5, "m")
    assert rows[2].exp_ids == ""


def test_missing_field_stops_and_null_passes(spark):
    doc = mixer()
    del doc["user_id"]
    with pytest.raises(Exception, match="missing field user_id"):
        flatten.flatten_mixer_log(lines(spark, doc)).collect()
    assert flatten.flatten_mixer_log(lines(spark, mixer(user_id=None))).first().user_id is None
    doc = mixer()
    del doc["model_results"]["res_model"][0]["model_spec"]
    with pytest.raises(Exception, match="missing field model_spec"):
        flatten.flatten_mixer_log(lines(spark, doc)).collect()


def test_malformed_lines(spark):
    raw = lines(spark, mixer(), "{broken")
    with pytest.raises(Exception):
        flatten.flatten_mixer_log(raw).collect()
    assert flatten.flatten_mixer_log(raw, "quarantine").count() == 2
    assert [r.value for r in malformed_lines(raw, schemas.MIXER_LOG).collect()] == ["{broken"]


def test_open_ads(spark):
    ad = {"camp_id": 1, "price": 1.25, "ok": True, "none": None, "deep": {"l": [1, "é"]}, "feature": {"big": 1}}
    raw = lines(spark, {"rec_ads": [ad], "req_ads": [ad, ad]}, {"other": 1}, {"rec_ads": [], "req_ads": []})
    (got,) = flatten.flatten_rec_log(raw).collect()
    assert json.loads(got.value) == {k: v for k, v in ad.items() if k != "feature"}
    got = flatten.flatten_req_ads(raw).collect()
    assert [json.loads(r.value) for r in got] == [ad, ad]


def test_train_feature(spark):
    ad = {"camp_id": "12", "creative_id": 34, "request_id": "r", "feature": {"a": [1, {"b": None}]}}
    (row,) = flatten.flatten_train_feature(lines(spark, {"rec_ads": [ad]})).collect()
    assert (row.ad_id, row.creative_id, row.request_id) == (12, 34, "r")
    assert json.loads(row.feature) == ad["feature"]
    assert flatten.flatten_train_feature(lines(spark, {"rec_ads": [{**ad, "feature": None}]})).first().feature == "null"
    with pytest.raises(Exception):
        flatten.flatten_train_feature(lines(spark, {"rec_ads": [{**ad, "camp_id": "x1"}]})).collect()
    with pytest.raises(Exception, match="missing field feature"):
        flatten.flatten_train_feature(lines(spark, {"rec_ads": [{k: v for k, v in ad.items() if k != "feature"}]})).collect()


def log(spark, *rows):
    return spark.createDataFrame(
        list(rows), "requestid string, beyla_id string, country string, pos_id string, package_name string, event_name string, "
        "sub_platform string, succ_camp string"
    )


def test_project_imp_click(spark):
    camp = json.dumps({"c_id": 3, "campaign_id": "4", "ad_package_name": "x"})
    rows = log(
        spark,
        ("1", "u", "EG", "p", "app", "AD_CpiShow", "cpi", camp), ("2", "u", "EG", "p", "app", "AD_Other", "cpi", camp),
        ("3", "u", "EG", "p", "other", "AD_CpiShow", "cpi", camp), ("4", "u", "EG", "p", "app", "AD_CpiClick", "web", camp),
        ("5", "ü", None, "p", "app", "AD_CpiClick", "cpi", camp),
    )
    got = project.project_imp_click(rows, ["app"]).collect()
    assert [r.requestid for r in got] == ["1", "5"]
    assert tuple(got[0]) == ("1", "u", "EG", "p", "app", "AD_CpiShow", "x", "4", "3")
    assert [r.requestid for r in project.project_imp_click(rows, ["app"], ascii_only=True).collect()] == ["1"]
    with pytest.raises(Exception, match="missing field campaign_id"):
        project.project_imp_click(log(spark, ("1", "u", "EG", "p", "app", "AD_CpiShow", "cpi", '{"c_id":1,"ad_package_name":"x"}')), ["app"]).collect()


def test_project_and_exclude_installs(spark):
    cols = "requestid string, beyla_id string, nation string, placement string, channel_pkg string, pkg_name string, cpi_camp_id int, c_id int, source string"
    df = spark.createDataFrame([("1", "u", "EG", "p", "app", "x", 1, 2, "cpi"), ("2", "u", "EG", "p", "app", "x", 1, 2, "web"), ("3", "u", None, "p", "bad", "x", 1, 2, "cpi")], cols)
    out = project.project_install(df, ["app", "bad"])
    assert out.columns == list(project.INSTALL_COLUMNS)
    assert [r.requestid for r in out.collect()] == ["1", "3"]
    assert [r.requestid for r in project.exclude_package(out, "bad").collect()] == ["1"]
    null = spark.createDataFrame([(None,)], "package_name string")
    assert project.exclude_package(null, "bad").count() == 1


def test_hours(spark):
    assert shifted_partition("2024013120") == "datepart=20240201/hour=04"
    assert shifted_partition("2024123116", layout="%Y/%m/%d/%H") == "2025/01/01/00"
    row = spark.createDataFrame([("2024022820",)], "h string").select(shift_hour("h", 8).alias("x")).first()
    assert row.x == "2024022904"
    assert spark.range(1).select(shift_hour(F.lit("2024010103"), -8).alias("x")).first().x == "2023123119"
