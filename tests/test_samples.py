import json

import pytest
from pyspark.sql import functions as F

from adfeat.config import MAIN, NATION
from adfeat.operators import counters, samples
from adfeat.operators.profile import user_profiles
from registry import fixtures as fx
from registry import queries as q

SF = "/root/testdata/sf0.001"


def inputs(spark, variant=MAIN):
    labels = fx.labels(spark, SF)
    accu = fx.accu(spark, SF, users=True)
    return labels, counters.ad_counters(accu, variant), counters.user_counters(accu, variant), q._profiles(spark, SF)


def brute(spark, variant=MAIN):
    """Sample documents assembled row by row in Python."""
    labels, ads, users, profiles = (df.collect() for df in inputs(spark, variant))
    text = lambda v: "None" if v is None else str(v)
    cell_of = {}
    for r, owner in [(r, r.nation if variant.nation_prefix else None) for r in ads] + [(r, r.user_id) for r in users]:
        counts = {n: v for n, v in (("imp", r.imp), ("click", r.click), (variant.install_field, r.attr_install)) if v > 0}
        cell_of.setdefault((owner, r.dim_set, r.dim_key), {})["countFeatures" + r.window_tag] = counts
    prof = {p.user_id: p for p in profiles}
    out = {}
    for r in labels:
        def cells(sets, owner):
            return {s.slot: cell_of.get((owner, s.name, "#".join(text(r[d]) for d in s.dims)), {}) for s in sets}

        p = prof.get(r.user_id)
        base = p.userBase.asDict() if p and p.userBase else {}
        beh = {k: v for k, v in p.userBehavior.asDict().items() if v is not None} if p and p.userBehavior else {}
        none = {s.slot: {} for s in variant.user_sets}
        mine = cells(variant.user_sets, r.user_id) if r.user_id is not None else none
        own = {"userId": mine.pop("userId")}
        out[r.rid] = {
            "label": {"click": r.is_click, variant.install_field: r.is_attr_install},
            "feature": {
                "userProfile": {"userId": r.user_id, "userBase": base, "userBehavior": beh, "userCounter": own},
                "userAdFeature": {"userAdCount": mine},
                "context": {
                    "posId": r.pos_id, "appName": r.package_name, **({"nation": r.nation} if variant.nation_prefix else {}),
                    "osVersion": r.os_version, "brand": r.brand, "model": r.model, "language": r.system_language,
                    "appVersionCode": r.app_version_code, "clientIp": r.client_ip, "reqTime": r.server_time,
                },
                "adData": {
                    "adInfo": {"adId": r.ad_id, "appId": r.ad_package_name, "category": r.ad_package_category,
                               "isAutoDownload": r.is_auto_download, "creativeId": text(r.c_id)},
                    "adCounter": cells(variant.ad_sets, r.nation if variant.nation_prefix else None),
                },
            },
        }
    return out


@pytest.mark.parametrize("variant", [MAIN, NATION], ids=lambda v: v.name)
@pytest.mark.parametrize("hot_rows", [3, 10**9])
def test_against_row_by_row_assembly(spark, variant, hot_rows):
    out = samples.assemble_samples(*inputs(spark, variant), variant, ("rid",), hot_rows)
    got = {r.rid: json.loads(r.s) for r in out.select("rid", samples.sample_json().alias("s")).collect()}
    want = brute(spark, variant)
    assert got == want
    assert any(s["feature"]["userProfile"]["userCounter"]["userId"] for s in got.values())
    assert any(s["feature"]["adData"]["adCounter"]["cId"] for s in got.values())


def test_every_label_survives_once(spark):
    labels, *rest = inputs(spark)
    out = samples.assemble_samples(labels.unionAll(labels), *rest, keep=("rid",), hot_rows=2)
    assert out.count() == 2 * labels.count()


def test_odd_texts_stay_valid_json(spark):
    odd = 'x}{"\\#\té'
    labels, ads, users, _ = inputs(spark)
    labels = labels.withColumns({"user_id": F.lit(odd), "ad_package_name": F.lit(odd), "client_ip": F.lit(odd)})
    base = spark.createDataFrame([(odd, "", "", "", odd, odd)], "user_id string, age string, gender string, country string, province string, city string")
    behaviour = spark.createDataFrame([(odd, "ad_app_click", [odd])], "user_id string, action_type string, app_list array<string>")
    out = samples.assemble_samples(labels, ads, users, user_profiles(base, behaviour))
    doc = json.loads(out.select(samples.sample_json().alias("s")).first().s)["feature"]
    assert doc["userProfile"]["userId"] == doc["userProfile"]["userBase"]["city"] == doc["context"]["clientIp"] == doc["adData"]["adInfo"]["appId"] == odd
    assert doc["userProfile"]["userBehavior"] == {"clickAdAppList": [odd]}


def test_dates():
    samples.check_dates("2024-01-30", "2024-01-31")
    for bad in ("2024-01-31", "2024-02-01"):
        with pytest.raises(ValueError):
            samples.check_dates(bad, "2024-01-31")


def test_feature_date(spark):
    assert str(spark.range(1).select(samples.feature_date_of(F.to_date(F.lit("2024-03-01"))).alias("d")).first().d) == "2024-02-29"


def test_logged_join_multiplies_duplicates(spark):
    labels = spark.createDataFrame([("r", 1, 2, 1, 0), ("r", 1, 2, 0, 0), ("s", 1, 2, 0, 0)], "rid string, ad_id bigint, c_id bigint, is_click int, is_attr_install int")
    logged = spark.createDataFrame([(1, 2, "r", '{"a":null}'), (1, 2, "r", '{"a":"é"}'), (1, 3, "s", "{}")], "ad_id bigint, creative_id bigint, request_id string, feature string")
    out = samples.join_logged_features(labels, logged).select(samples.logged_sample_json().alias("s")).collect()
    docs = [json.loads(r.s) for r in out]
    assert len(docs) == 4
    assert {"label": {"click": 1, "attrInstall": 0}, "feature": {"a": None}} in docs


def test_assembly_stays_in_the_jvm(spark):
    plan = samples.assemble_samples(*inputs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
