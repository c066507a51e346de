"""Explicit schemas of the inputs."""

from __future__ import annotations

MIXER_LOG = (
    "request_id string, user_id string, pos_id string, timestamp bigint, hit_exp array<string>, "
    "model_results struct<res_model: array<struct<app_id: string, camp_id: string, creative_id: string, "
    "ecpm: double, model_spec: string>>>"
)
REC_LOG_OPEN = "rec_ads array<map<string, variant>>"
REC_LOG_FEATURES = "rec_ads array<struct<camp_id: string, creative_id: string, request_id: string, feature: string>>"
REQ_ADS_LOG = "req_ads array<string>"
SUCC_CAMP = "c_id string, campaign_id string, ad_package_name string"

# the stream may send ids as numbers or text
STREAM_ENVELOPE = "message string"
STREAM_MESSAGE = (
    "sub_pf string, event_name string, package_name string, pos_id string, beyla_id string, "
    "params array<struct<ad_package_name: string, campaign_id: string, c_id: string>>"
)

TRAIN_FEATURE = "ad_id bigint, creative_id bigint, request_id string, feature string"

# positional TSV files
IMP_CLICK_TSV = (
    "requestid string, beyla_id string, country string, pos_id string, package_name string, "
    "event_name string, ad_package_name string, ad_id string, c_id string"
)
INSTALL_TSV = (
    "requestid string, beyla_id string, country string, pos_id string, package_name string, "
    "ad_package_name string, ad_id string, c_id string"
)
RATE_TSV = (
    "beyla_id string, ad_package_name string, ad_id string, c_id string, pctr double, pcvr double, "
    "bid double, is_click int, is_attr_install int"
)
ECPM_TSV = (
    "beyla_id string, ad_package_name string, ad_id string, c_id string, pctcvr string, "
    "is_click int, is_attr_install int, bid_price double"
)
FEATURE_COUNTS_TSV = "fea_k string, fea_v string, click int, install int, imp bigint"
CALIBRATION_MODEL = "bucket bigint, n double, clicks double, prate double, rate double"

PROFILE_BASE = ("age", "gender", "country", "province", "city")
