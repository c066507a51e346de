"""Nested JSON log lines to one row per ad. Input is a text column ``value``.

All of these stay inside one scan stage: parse, explode, project; nothing is shuffled.
Lines without ads give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adfeat import schemas
from adfeat.functions.jsontext import must_have, parse_lines


def _element(path: str) -> Column:
    """JSON text of the exploded array element, to tell a missing field from a null one."""
    where = F.concat(F.lit(f"$.{path}["), F.col("pos").cast("string"), F.lit("]"))
    return F.call_function("get_json_object", F.col("value"), where)


def flatten_mixer_log(raw: DataFrame, mode: str = "failfast") -> DataFrame:
    """One row per scored ad of a response; ``model_spec`` is published as ``pctcvr``."""
    doc = parse_lines(raw, schemas.MIXER_LOG, mode)
    ads = doc.select("value", "doc", F.posexplode("doc.model_results.res_model").alias("pos", "ad"))

    def top(name: str):
        return must_have(F.col(f"doc.{name}"), name, F.col("value"))

    def ad(name: str):
        return must_have(F.col(f"ad.{name}"), name, _element("model_results.res_model"))

    return ads.select(
        top("request_id").alias("request_id"),
        F.concat_ws(",", F.col("doc.hit_exp")).alias("exp_ids"),
        top("user_id").alias("user_id"),
        top("pos_id").alias("pos_id"),
        top("timestamp").cast("bigint").alias("timestamp"),
        ad("app_id").alias("app_id"),
        ad("camp_id").alias("camp_id"),
        ad("creative_id").alias("creative_id"),
        ad("ecpm").cast("double").alias("ecpm"),
        ad("model_spec").alias("pctcvr"),
    )


def flatten_rec_log(raw: DataFrame, mode: str = "failfast") -> DataFrame:
    """One JSON text per recommended ad, all fields but ``feature``, types kept."""
    ads = parse_lines(raw, schemas.REC_LOG_OPEN, mode).select(F.explode("doc.rec_ads").alias("ad"))
    return ads.select(
        F.to_json(F.map_filter("ad", lambda k, _: k != "feature"), {"ignoreNullFields": "false"}).alias("value")
    )


def flatten_req_ads(raw: DataFrame, mode: str = "failfast") -> DataFrame:
    """One JSON text per requested ad, as logged."""
    return parse_lines(raw, schemas.REQ_ADS_LOG, mode).select(F.explode("doc.req_ads").alias("value"))


def flatten_train_feature(raw: DataFrame, mode: str = "failfast") -> DataFrame:
    """``(ad_id, creative_id, request_id, feature)`` per recommended ad, the feature as JSON text.

    Ids that are not whole numbers stop the job.
    """
    ads = parse_lines(raw, schemas.REC_LOG_FEATURES, mode).select("value", F.posexplode("doc.rec_ads").alias("pos", "ad"))

    def ad(name: str):
        return must_have(F.col(f"ad.{name}"), name, _element("rec_ads"))

    return ads.select(
        ad("camp_id").cast("bigint").alias("ad_id"),
        ad("creative_id").cast("bigint").alias("creative_id"),
        ad("request_id").alias("request_id"),
        F.coalesce(ad("feature"), F.lit("null")).alias("feature"),
    )
