import datetime as dt

from adfeat.operators import profile

BASE = "user_id string, age string, gender string, country string, province string, city string"
ACTS = "user_id string, action_type string, app_list array<string>"


def build(spark, **kw):
    base = spark.createDataFrame([("both", "20", None, "EG", "São", "Cairo"), ("base", None, None, None, None, None)], BASE)
    acts = spark.createDataFrame(
        [
            ("both", "app_use", ["b", "a", "a", "zz"]), ("both", "app_install", ["zz"]), ("both", "ad_app_click", ["zz", "a"]),
            ("both", "ad_app_click", ["a"]), ("both", "unknown", ["a"]), ("acts", "ad_app_install", None), ("noise", "unknown", ["a"]),
        ],
        ACTS,
    )
    apps = spark.createDataFrame([("a",), ("b",), ("a",)], "app string")
    return {r.user_id: r for r in profile.user_profiles(base, acts, apps, **kw).collect()}


def test_profiles(spark):
    users = build(spark)
    assert set(users) == {"both", "base", "acts"}
    both = users["both"]
    assert both.userBase.asDict() == {"age": "20", "gender": "", "country": "EG", "province": "São", "city": "Cairo"}
    assert both.userBehavior.asDict() == {
        "installAppList": [],  # nothing allowed, but the list was there
        "useAppList": ["a", "b"],
        "clickAdAppList": ["a", "zz"],  # the greater of the two rows, not restricted
        "installAdAppList": None,
    }
    assert users["base"].userBehavior is None and users["base"].userBase.city == ""
    assert users["acts"].userBase is None and users["acts"].userBehavior.installAdAppList == []


def test_ascii_only(spark):
    assert build(spark, ascii_only=True)["both"].userBase.province == ""


def test_base_only(spark):
    base = spark.createDataFrame([("u", "1", "f", "EG", "P", "C"), ("u", "2", "f", "EG", "P", "C")], BASE)
    (row,) = profile.user_profiles(base).collect()
    assert row.userBase.age == "2" and row.userBehavior is None


def test_ad_info(spark):
    cats = spark.createDataFrame([("pkg", "G"), ("ad_id#1", "H")], "package_name string, category string")
    now = dt.datetime(2024, 1, 31)
    creatives = spark.createDataFrame([(5, now - dt.timedelta(days=3)), (6, now - dt.timedelta(days=4)), (7, now)], "id bigint, create_time timestamp_ntz")
    campaigns = spark.createDataFrame([(1, 9), (2, 0), (3, -1)], "id bigint, day_max int")
    got = {r.info_key: tuple(r)[1:] for r in profile.ad_info(cats, creatives, campaigns, now).collect()}
    assert got == {
        "pkg": ("G", None, None),
        "ad_id#1": (None, None, 9),  # the later source replaces the whole entry
        "c_id#5": (None, 1706400000, None),
        "c_id#7": (None, 1706659200, None),
    }


def test_package_categories(spark):
    df = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", None)], "package_name string, category string")
    assert {r.package_name: r.category for r in profile.package_categories(df).collect()} == {"p": "b", "q": None}
