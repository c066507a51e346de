"""Inputs of the operators, derived from the driver tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from adfeat.config import AD_PLATFORM
from adfeat.functions.timing import epoch_seconds, hour_of

PACKAGES = ("app.one", "app.two", "app.three")
EXCLUDED_PACKAGE = "app.excluded"
ALLOWED_APPS = ("pkg0", "pkg1", "pkg2", "pkg3")
NOW = dt.datetime(2024, 1, 31)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once per process, later reads start no job for it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key over ``spark.sql.shuffle.partitions`` tasks, whatever files they come from.

    The inputs derived below cost more per row than reading it; a table of one file would leave that to one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def accu(spark: SparkSession, sf_dir: str, users: bool = False) -> DataFrame:
    """Pre-accumulated counts; every 13th creative id is missing."""
    line = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    part = table(spark, sf_dir, "part")
    rows = line
    if users:  # first: the rows lie by order already
        orders = table(spark, sf_dir, "orders")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey)
    rows = rows.join(part, rows.l_partkey == part.p_partkey)
    tag = F.element_at(F.array(*[F.lit(t) for t in ("1d", "3d", "7d", "14d", "30d", "7d", "7d")]), F.col("l_linenumber"))
    return rows.select(
        *([F.col("o_custkey").cast("string").alias("user_id")] if users else []),
        tag.alias("window_tag"),
        F.when(F.col("l_suppkey") % 3 == 0, "EG").when(F.col("l_suppkey") % 3 == 1, "ID").otherwise("IN").alias("nation"),
        F.when(F.col("l_returnflag") == "A", "app.one").when(F.col("l_returnflag") == "N", "app.two")
        .otherwise("app.three").alias("package_name"),
        F.col("l_linestatus").alias("pos_id"),
        (F.col("l_partkey") % 50).alias("ad_id"),
        F.col("p_brand").alias("ad_package_name"),
        F.col("p_type").alias("ad_package_category"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_suppkey")).alias("c_id"),
        F.floor("l_quantity").alias("imp"),
        F.floor(F.col("l_quantity") * F.col("l_discount")).alias("click"),
        F.floor(F.col("l_quantity") * F.col("l_tax")).alias("attr_install"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of its files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern may name a file or a folder


def scratch(spark: SparkSession) -> str:
    """New folder for what a query writes: in the shared folder the cluster names, else a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="run-", dir="/tmp")


def events(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Events with the ad dimensions derived from ``props``."""
    k = F.get_json_object("props", "$.k").cast("int")
    if rows is None:
        rows = spread(table(spark, sf_dir, "events"), "event_id")
    return rows.withColumn("k", k).select(
        "event_id", "user_id", "event_type", "value", "k", "ts",
        F.col("event_id").cast("string").alias("requestid"),
        F.col("user_id").cast("string").alias("beyla_id"),
        F.when(F.col("event_type") == "view", "AD_CpiShow").when(F.col("event_type") == "click", "AD_CpiClick")
        .alias("event_name"),
        F.concat(F.lit("p"), (F.col("k") % 4).cast("string")).alias("pos_id"),
        F.element_at(F.array(*[F.lit(p) for p in (*PACKAGES, EXCLUDED_PACKAGE, "app.other")]), (F.col("k") % 5) + 1)
        .alias("package_name"),
        (F.col("k") % 10).cast("bigint").alias("ad_id"),
        (F.col("k") % 25).cast("bigint").alias("c_id"),
        F.concat(F.lit("pkg"), (F.col("k") % 7).cast("string")).alias("ad_package_name"),
        hour_of("ts").alias("hour"),
    )


def cpi_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw impression and click log with the ad fields inside a JSON column."""
    e = events(spark, sf_dir)
    return e.select(
        "requestid", "beyla_id", F.lit("EG").alias("country"), "pos_id", "package_name",
        F.coalesce("event_name", "event_type").alias("event_name"),
        F.when(F.col("k") % 11 == 0, "other").otherwise(AD_PLATFORM).alias("sub_platform"),
        F.to_json(F.struct("c_id", F.col("ad_id").alias("campaign_id"), "ad_package_name")).alias("succ_camp"),
        "hour",
    )


def install_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw install postbacks under their upstream column names."""
    e = events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return e.select(
        "requestid", "beyla_id", F.lit("EG").alias("nation"), F.col("pos_id").alias("placement"),
        F.col("package_name").alias("channel_pkg"), F.col("ad_package_name").alias("pkg_name"),
        F.col("ad_id").alias("cpi_camp_id"), "c_id",
        F.when(F.col("k") % 11 == 0, "other").otherwise(AD_PLATFORM).alias("source"), "hour",
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled impressions whose dimension values meet those of :func:`accu`; some are missing."""
    e = events(spark, sf_dir).where(F.col("event_type") == "view")
    k = F.col("k")
    return e.select(
        F.col("event_id").cast("string").alias("rid"),
        F.when(k % 17 != 0, F.col("beyla_id")).alias("user_id"),
        F.when(k % 3 == 0, "EG").otherwise("ID").alias("nation"),
        "package_name",
        F.when(k % 3 == 0, "O").when(k % 3 == 1, "F").alias("pos_id"),
        F.concat(F.lit("10.0.0."), k.cast("string")).alias("client_ip"),
        epoch_seconds("ts").alias("server_time"),
        F.lit("11").alias("os_version"), F.lit("b").alias("brand"), F.concat(F.lit("m"), (k % 3).cast("string")).alias("model"),
        F.when(k % 4 != 0, "en").alias("system_language"), F.lit("100").alias("app_version_code"),
        F.concat(F.lit("Brand#"), (k % 30).cast("string")).alias("ad_package_name"),
        F.element_at(F.array(*[F.lit(c) for c in ("ECONOMY", "STANDARD", "PROMO")]), (k % 3) + 1).alias("ad_package_category"),
        (k % 50).cast("bigint").alias("ad_id"),
        F.when(k % 13 != 0, k.cast("bigint")).alias("c_id"),
        (k % 2).cast("bigint").alias("is_auto_download"),
        (k % 3 == 0).cast("int").alias("is_click"),
        (k % 9 == 0).cast("int").alias("is_attr_install"),
        F.col("value").alias("bid_price"),
    )


def mixer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response document per line item with one or two scored ads; every seventh position has none."""
    line = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    number = F.col("l_linenumber")

    def ad(i: int):
        return F.struct(
            F.col("l_returnflag").alias("app_id"), (F.col("l_partkey") % 50 + i).alias("camp_id"),
            F.col("l_suppkey").alias("creative_id"), (F.col("l_extendedprice") + i).alias("ecpm"),
            F.concat(F.lit("spec"), number.cast("string")).alias("model_spec"),
        )

    ads = F.when(number % 2 == 0, F.array(ad(0), ad(1))).otherwise(F.array(ad(0)))
    return line.select(F.to_json(F.struct(
        F.col("l_orderkey").cast("string").alias("request_id"), F.col("l_partkey").cast("string").alias("user_id"),
        F.col("l_linestatus").alias("pos_id"), epoch_seconds("l_shipdate").alias("timestamp"),
        F.when(number > 1, F.array(F.concat(F.lit("e"), number.cast("string")), F.lit("x"))).alias("hit_exp"),
        F.when(number < 7, F.struct(ads.alias("res_model"))).alias("model_results"),
    )).alias("value"))


def ads_lines(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    """One document per event with two ads under ``field``, or without that field."""
    k = F.col("k")

    def ad(i: int):
        return F.struct(
            (F.col("ad_id") + i).alias("camp_id"), F.col("c_id").cast("string").alias("creative_id"),
            F.col("requestid").alias("request_id"), F.when(k % 2 == 0, F.lit("n")).alias("note"),
            F.array(F.lit("a"), F.col("pos_id")).alias("tags"),
            F.struct(F.col("k").alias("k"), F.col("pos_id").alias("p")).alias("feature"),
        )

    ads = F.when(k % 7 != 0, F.array(ad(0), ad(1)))
    docs = events(spark, sf_dir).select(F.concat(
        F.lit("{"), F.coalesce(F.concat(F.lit(f'"{field}":'), F.to_json(ads, {"ignoreNullFields": "false"})), F.lit('"other":1')), F.lit("}")
    ).alias("value"))
    return docs


def _other(same: Column, key: Column) -> Column:
    """The key, or one that nothing else has: rows that are to match nothing."""
    return F.when(same, key).otherwise(F.concat(F.lit("x"), key))


def logged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature log of the label events, one ad each; low bids were logged for other requests, missing creatives as -1."""
    rows = labels(spark, sf_dir)
    ad = F.struct(
        F.col("ad_id").cast("string").alias("camp_id"), F.coalesce("c_id", F.lit(-1)).cast("string").alias("creative_id"),
        _other(F.col("bid_price") >= 11, F.col("rid")).alias("request_id"), F.struct(F.col("client_ip").alias("ip"), F.col("is_auto_download").alias("auto")).alias("feature"),
    )
    return rows.select(F.to_json(F.struct(F.array(ad).alias("rec_ads"))).alias("value"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores logged for the label events; those of low bids under other request ids."""
    rows = labels(spark, sf_dir)
    k = F.col("is_auto_download")
    return rows.select(
        _other(F.col("bid_price") >= 5, F.col("rid")).alias("request_id"), F.col("c_id").alias("creative_id"), F.col("ad_id").alias("camp_id"),
        F.col("ad_package_name").alias("app_id"), "package_name",
        (k / 4).alias("pctr"), (F.col("ad_id") / 64).alias("pcvr"),
    )


def user_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base attributes of customers; those whose account is overdrawn have ids that no event has."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        _other(F.col("c_acctbal") >= 0, key.cast("string")).alias("user_id"),
        F.when(key % 4 != 0, (20 + key % 50).cast("string")).alias("age"),
        F.when(key % 3 != 0, F.when(key % 2 == 0, "m").otherwise("f")).alias("gender"),
        F.col("n_name").alias("country"), F.col("r_name").alias("province"), F.col("c_mktsegment").alias("city"),
    )


def user_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apps per user and behaviour type."""
    installed = (F.col("event_type") == "signup") & (F.col("value") < 5)  # other signups are no behaviour
    kind = F.when(F.col("event_type") == "view", "app_use").when(installed, "app_install") \
        .when(F.col("event_type") == "click", "ad_app_click").when(F.col("event_type") == "purchase", "ad_app_install") \
        .otherwise(F.col("event_type"))
    return events(spark, sf_dir).groupBy(F.col("beyla_id").alias("user_id"), kind.alias("action_type")).agg(
        F.collect_set("ad_package_name").alias("app_list")
    )


def allowed_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow-list: the app names of events with a small ``k`` and a few more."""
    return events(spark, sf_dir).where(F.col("ad_package_name").isin(*ALLOWED_APPS)).select(
        F.col("ad_package_name").alias("app")
    ).distinct()


def creatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.expr("timestamp_ntz'2024-01-30 00:00:00' - make_dt_interval(cast(s_suppkey as int))").alias("create_time"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") - 10).alias("day_max"))


def app_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("package_name"), F.col("p_type").alias("category"))


def rate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored impressions; the text score is ``NULL`` for line number 7."""
    pctr = F.col("l_discount") + F.col("l_tax") / 100
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("beyla_id"), F.col("l_partkey").cast("string").alias("ad_id"),
        F.col("l_suppkey").cast("string").alias("c_id"), pctr.alias("pctr"), F.col("l_tax").alias("pcvr"),
        (F.col("l_extendedprice") / 1000).alias("bid_price"),
        F.when(F.col("l_linenumber") == 7, "NULL").otherwise((pctr * F.col("l_tax")).cast("string")).alias("pctcvr"),
        (F.col("l_returnflag") == "A").cast("int").alias("is_click"),
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).cast("int").alias("is_attr_install"),
        (F.col("l_extendedprice") - 50000).alias("margin"),
    )


HALF = "2024-01-16"


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events as a stream gets them: the first half of the month, the second, what comes late of both, and a message from a later
    month that closes every window."""
    rows = events(spark, sf_dir).select("event_id", "ad_id", "k", F.col("ts").cast("timestamp").alias("ts"))
    late = F.col("k") % 17 == 0
    end = spark.createDataFrame([(None, -1, None, dt.datetime(2024, 6, 1))], rows.schema)
    return [rows.where(~late & (F.col("ts") < HALF)), rows.where(~late & (F.col("ts") >= HALF)), rows.where(late), end]


def stream_lines(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Event messages in their envelope, one or two items each; those of a low value are malformed."""
    e = events(spark, sf_dir, rows=rows)
    item = F.struct("ad_package_name", F.col("ad_id").alias("campaign_id"), "c_id")
    other = F.struct(
        F.when(F.col("k") % 6 != 0, F.col("ad_package_name")).alias("ad_package_name"),
        (F.col("ad_id") + 1).alias("campaign_id"), F.col("c_id").alias("c_id"),
    )
    message = F.to_json(F.struct(
        F.when(F.col("k") % 11 == 0, "other").otherwise(AD_PLATFORM).alias("sub_pf"),
        F.coalesce("event_name", "event_type").alias("event_name"), "package_name",
        F.when(F.col("k") % 4 != 0, F.col("pos_id")).alias("pos_id"),
        F.when(F.col("k") % 9 != 0, F.col("beyla_id")).otherwise("").alias("beyla_id"),
        F.when(F.col("k") % 2 == 0, F.array(item, other)).otherwise(F.array(item)).alias("params"),
    ))
    return e.select(
        F.when(F.col("value") < 1, "{broken").otherwise(F.to_json(F.struct(message.alias("message")))).alias("value"), "ts"
    )
