"""Registered queries: each runs one operator over whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat.config import MAIN, NATION, SmoothingRules, USER_COUNTER_KEY_PREFIX, USER_PROFILE_KEY_PREFIX, dim_sets
from adfeat.functions.keys import ascii_or_empty
from adfeat.functions.timing import hour_of, local_day_hours, shift_hour
from adfeat.operators import calibration as cal
from adfeat.operators import counters, features, flatten, profile, project, ranking, refresh, samples
from adfeat.plans import hourly
from adfeat.sinks import export, ordered, publish
from adfeat.sources import catalogue, logs, stores
from adfeat.streaming import events as stream
from registry import fixtures as fx

RULES = SmoothingRules(category_min_imp=12_000, name_min_imp=3_000, name_floor_imp=50, imps_per_install=1_000)
PUBLISHED_AT = 1_706_659_200


def ad_counter_rollup(spark: SparkSession, d: str) -> DataFrame:
    return counters.ad_counters(fx.accu(spark, d))


def ad_counter_rollup_nation(spark, d):
    return counters.ad_counters(fx.accu(spark, d), NATION)


def _user_tasks(spark, d):
    return counters.user_tasks(spark, fx.table(spark, d, "lineitem").count())  # from the file footers


def _user_rows(spark, d, tasks=None):
    return counters.user_counter_rows(counters.by_user(fx.accu(spark, d, users=True), tasks or _user_tasks(spark, d)))


def user_counter_rollup(spark, d):
    return counters.user_counters(fx.accu(spark, d, users=True), tasks=_user_tasks(spark, d))


def user_counter_rollup_nation(spark, d):
    rows = fx.accu(spark, d, users=True).where((F.col("window_tag") == "3d") & (F.col("nation") == "EG"))
    return counters.user_counters(rows, NATION)


def ad_counter_documents(spark, d):
    return counters.counter_documents(ad_counter_rollup(spark, d))


def ad_counter_documents_nation(spark, d):
    return counters.counter_documents(ad_counter_rollup_nation(spark, d), NATION, ("nation",))


def counter_documents_read(spark, d):
    return stores.counters_of_documents(ad_counter_documents(spark, d))


def _only(*sets: str):
    """Variant with a few dimension sets: what a reader of a snapshot split by set would touch."""
    return MAIN.with_(ad_sets=dim_sets(sets))


def global_totals(spark, d):
    return counters.window_totals(counters.ad_counters(fx.accu(spark, d), _only("ad_package_category")))


# recent events and snapshot refresh

def project_imp_click(spark, d):
    return project.project_imp_click(fx.cpi_log(spark, d), fx.PACKAGES)


def project_install(spark, d):
    return project.project_install(fx.install_log(spark, d), fx.PACKAGES)


def imp_click_tsv(spark, d):
    return export.tsv_lines(project_imp_click(spark, d))


def _recent(spark, d):
    """Impressions with clicks, and installs, of the newest 24 hours of each log."""
    packages = (*fx.PACKAGES, fx.EXCLUDED_PACKAGE)
    shows = project.project_imp_click(logs.last_partitions(fx.cpi_log(spark, d)), fx.PACKAGES, keep=("hour",))
    installs = project.project_install(logs.last_partitions(fx.install_log(spark, d)), packages, keep=("hour",))
    return shows, project.exclude_package(installs, fx.EXCLUDED_PACKAGE)


def last_24_partitions(spark, d):
    return logs.last_partitions(fx.events(spark, d)).select("event_id", "hour")


def latest_snapshot(spark, d):
    orders = fx.table(spark, d, "orders").withColumn("dt", F.date_format("o_orderdate", "yyyyMMdd"))
    return logs.latest_snapshot(orders).select("o_orderkey", "o_custkey", "dt")


def source_hours(spark, d):
    return fx.table(spark, d, "events").select(
        "event_id", hour_of("ts").alias("out_hour"), shift_hour(hour_of("ts"), 8).alias("log_hour")
    )


def hourly_recount(spark, d):
    return counters.event_counters(*_recent(spark, d))


def bj_day_install(spark, d):
    return counters.local_day_installs(_recent(spark, d)[1], *local_day_hours(fx.NOW))


def counter_refresh(spark, d):
    shows, installs = _recent(spark, d)
    return refresh.refresh_snapshot(
        ad_counter_rollup(spark, d),
        counters.event_counters(shows, installs),
        counters.local_day_installs(installs, *local_day_hours(fx.NOW)),
    )


def _merged(spark, d):
    accu = fx.accu(spark, d)
    sets = _only(*refresh.SMOOTHED_SETS)
    renamed = F.when(F.col("ad_package_name") == "Brand#1", "Brand#1x").otherwise(F.col("ad_package_name"))  # in one of both only
    day = counters.ad_counters(accu.withColumn("ad_package_name", renamed), sets)
    return refresh.merge_smooth(day, counters.ad_counters(accu, sets), RULES)


def counter_merge_smooth(spark, d):
    return _merged(spark, d).withColumn("day_cvr", F.round("day_cvr", 9))


def merged_views(spark, d):
    return export.merged_views(_merged(spark, d))


def wilson_scores(spark, d):
    score = refresh.wilson_lower_bound(F.col("attr_install"), F.col("imp"))
    return ad_counter_rollup(spark, d).select("dim_set", "dim_key", "window_tag", F.round(score, 9).alias("score"))


# log flattening

def flatten_mixer_log(spark, d):
    return flatten.flatten_mixer_log(fx.mixer_lines(spark, d))


def flatten_rec_log(spark, d):
    return flatten.flatten_rec_log(fx.ads_lines(spark, d, "rec_ads"))


def flatten_req_ads(spark, d):
    return flatten.flatten_req_ads(fx.ads_lines(spark, d, "req_ads"))


def flatten_train_feature(spark, d):
    return flatten.flatten_train_feature(fx.ads_lines(spark, d, "rec_ads"))


# profiles and ad information

def _profiles(spark, d):
    return profile.user_profiles(fx.user_base(spark, d), fx.user_behaviour(spark, d), fx.allowed_apps(spark, d))


def user_profile(spark, d):
    lists = [
        F.when(F.col(f"userBehavior.{s}").isNotNull(), F.concat_ws(",", f"userBehavior.{s}")).alias(a)
        for s, a in (("installAppList", "install_apps"), ("useAppList", "use_apps"),
                     ("clickAdAppList", "click_apps"), ("installAdAppList", "install_ad_apps"))
    ]
    return _profiles(spark, d).select("user_id", "userBase.*", *lists)


def user_profile_base(spark, d):
    return profile.user_profiles(fx.user_base(spark, d)).select("user_id", "userBase.*")


def ascii_guard(spark, d):
    head = F.substring("text", 1, 1)
    return fx.table(spark, d, "conversations").select("conv_id", "turn", ascii_or_empty(F.col("text")).alias("kept"), ascii_or_empty(head).alias("head"))


def package_category(spark, d):
    return profile.package_categories(fx.app_category(spark, d))


def adinfo_overlay(spark, d):
    return profile.ad_info(package_category(spark, d), fx.creatives(spark, d), fx.campaigns(spark, d), fx.NOW)


def adinfo_documents(spark, d):
    return export.ad_info_documents(adinfo_overlay(spark, d))


# training samples

def _sample_labels(spark, d):
    return fx.labels(spark, d).where(F.col("package_name").isin(*fx.PACKAGES))


def train_sample_lookup(spark, d):
    labels = _sample_labels(spark, d)
    users = samples.of_label_users(fx.accu(spark, d, users=True), labels)
    out = samples.assemble_samples(
        labels, ad_counter_rollup(spark, d), counters.user_counter_rows(users), _profiles(spark, d), MAIN, ("rid",),
    )
    return out.select("rid", samples.sample_json().alias("sample"))


def train_sample_nation(spark, d):
    out = samples.assemble_samples(
        fx.labels(spark, d).where(F.col("nation") == "EG"), ad_counter_rollup_nation(spark, d),
        user_counter_rollup_nation(spark, d), profile.user_profiles(fx.user_base(spark, d)), NATION, ("rid",),
    )
    return out.select("rid", samples.sample_json().alias("sample"))


def train_sample_logged(spark, d):
    logged = flatten.flatten_train_feature(fx.logged_lines(spark, d))
    joined = samples.join_logged_features(_sample_labels(spark, d), logged)
    return joined.select("rid", samples.logged_sample_json().alias("sample"))


def scored_labels(spark, d):
    rows = fx.labels(spark, d).withColumn("beyla_id", F.col("user_id"))
    return samples.score_labels(rows, fx.scored(spark, d), "app.two")


# feature analysis

def _label_features(spark, d):
    e = fx.events(spark, d).where(F.col("event_type") == "view")
    k = F.col("k")
    extract = features.column_extractor(
        (k % 3 == 0).cast("int"), (k % 9 == 0).cast("int"),
        {
            "ctx_pos": F.col("pos_id"), "ctx_ad_pkg": F.col("ad_package_name"), "up_uid": F.col("user_id"),
            "ad_ai_cid": F.col("c_id"), "ad_ai_aid": F.col("ad_id"), "ctx_ne3": k % 2, "ctx_ip": k,
            "up_uc/7d": k % 8, "ad_ac": F.when(k % 6 != 5, k % 6), "const": F.lit(1),
        },
    )
    return features.feature_label_counts(e, extract)


def feature_label_counts(spark, d):
    return _label_features(spark, d)


def feature_counts_sparse(spark, d):
    """Counts of samples most of which have no features at all."""
    e = fx.events(spark, d).where(F.col("event_type") == "view")
    k = F.col("k")
    extract = features.column_extractor((k % 3 == 0).cast("int"), (k % 9 == 0).cast("int"), {"rare": F.when(k % 10 == 0, k), "pos": F.when(k % 20 == 0, F.col("pos_id"))})
    return features.feature_label_counts(e, extract)


def feature_index_lines(spark, d):
    """Index sizes through their TSV artefact."""
    path = f"{fx.scratch(spark)}/index"
    export.write_tsv(features.index_allocation(_label_features(spark, d)), path)
    return spark.read.text(path)


def mi_ctr(spark, d):
    return features.mutual_information(_label_features(spark, d)).withColumn("mi", F.round("mi", 9))


def mi_cvr(spark, d):
    return features.mutual_information(_label_features(spark, d), "install").withColumn("mi", F.round("mi", 9))


def chi_square_stat(spark, d):
    return features.chi_square(_label_features(spark, d)).withColumn("stat", F.round("stat", 6))


def chi_square_uncorrected(spark, d):
    return features.chi_square(_label_features(spark, d), yates=False).withColumn("stat", F.round("stat", 6))


def chi_square_test(spark, d):
    out = features.chi_square_test(_label_features(spark, d))
    return out.withColumns({"stat": F.round("stat", 6), "critical": F.round("critical", 6), "p_value": F.round("p_value", 8)})


def index_allocation(spark, d):
    return features.index_allocation(_label_features(spark, d))


def index_allocation_compact(spark, d):
    return features.index_allocation(_label_features(spark, d), compact=True)


def encoded_examples(spark, d):
    return features.encoded_examples(fx.labels(spark, d), F.concat_ws("|", "rid", "client_ip", F.col("c_id").cast("string")))


# calibration and ranking metrics

def _model(spark, d):
    return cal.isotonic_model(cal.ctr_buckets(fx.rate_rows(spark, d)))


def ctr_buckets(spark, d):
    return cal.ctr_buckets(fx.rate_rows(spark, d))


def isotonic_model(spark, d):
    return _model(spark, d).withColumn("rate", F.round("rate", 9))


def calibrated_scores(spark, d):
    return cal.calibrate(fx.rate_rows(spark, d), _model(spark, d)).select(
        "beyla_id", "ad_id", "c_id", F.round("pctr", 9).alias("pctr"), F.round("calibrated", 9).alias("calibrated")
    )


def calibrated_scores_inclusive(spark, d):
    return cal.calibrate(fx.rate_rows(spark, d), _model(spark, d), match="inclusive").select(
        "beyla_id", "ad_id", "c_id", F.round("pctr", 9).alias("pctr"), F.round("calibrated", 9).alias("calibrated")
    )


def calibration_bias(spark, d):
    out = cal.calibration_bias(fx.rate_rows(spark, d), _model(spark, d))
    return out.select(F.round("mean_score", 9).alias("mean_score"), F.round("mean_label", 9).alias("mean_label"))


def auc(spark, d):
    return ranking.auc(fx.rate_rows(spark, d), "pctr", "is_click").select(F.round("auc", 9).alias("auc"))


def auc_signed(spark, d):
    return ranking.auc(fx.rate_rows(spark, d), "margin", "is_attr_install").select(F.round("auc", 9).alias("auc"))


def bid_weighted_auc(spark, d):
    return ranking.bid_weighted_auc(ranking.ecpm_rows(fx.rate_rows(spark, d))).select(F.round("auc", 9).alias("auc"))


def calibration_model_file(spark, d):
    """The model through its ordered file, in parts of a few lines."""
    path = f"{fx.scratch(spark)}/model"
    ordered.write_calibration_model(_model(spark, d), path, lines_per_file=4)
    model = ordered.read_calibration_model(spark, path)
    return model.select("position", "bucket", F.col("n").cast("bigint").alias("n"), F.col("clicks").cast("bigint").alias("clicks"), F.round("rate", 9).alias("rate"))


# files, catalogue and stores

def recount_from_files(spark, d):
    """The recount of the newest hours through TSV folders per hour, positions of some rows being empty."""
    root = fx.scratch(spark)
    some = F.when(F.col("pos_id") != "p3", F.col("pos_id")).otherwise("")
    shows = project.project_imp_click(fx.cpi_log(spark, d), fx.PACKAGES, keep=("hour",)).withColumn("pos_id", some)
    installs = project.project_install(fx.install_log(spark, d), (*fx.PACKAGES, fx.EXCLUDED_PACKAGE), keep=("hour",)).withColumn("pos_id", some)
    for name, rows in (("shows", shows), ("installs", installs)):
        export.write_hourly_tsv(rows, f"{root}/{name}")
    return counters.event_counters(*hourly.recent_events(spark, f"{root}/shows", f"{root}/installs", fx.EXCLUDED_PACKAGE))


def catalogue_hours(spark, d):
    """Events through an hourly table of the catalogue; the last hour of each day is written and registered late."""
    root, name = fx.scratch(spark), f"hours_{uuid.uuid4().hex}"
    rows = fx.events(spark, d).select("event_id", "event_type", "k", "hour")
    catalogue.create_hour_table(spark, name, "event_id BIGINT, event_type STRING, k INT", root)
    late = F.substring("hour", 9, 2) == "23"
    for part in (rows.where(~late), rows.where(late)):
        catalogue.write_hours(part, root)
        catalogue.register_hours(spark, name, catalogue.hours_of(part))
    return catalogue.scan_hours(spark, name)


def hour_lines_read(spark, d):
    """Flattened lines written per hour as JSON and read back a month at a time."""
    root = fx.scratch(spark)
    lines = fx.events(spark, d).select("hour", F.to_json(F.struct("event_id", "pos_id", "k")).alias("value"))
    catalogue.write_hours(lines, root, form="text")
    return logs.read_day_json(spark, root, "202401*", "event_id bigint, pos_id string, k int")


def log_hour_read(spark, d):
    """Raw lines of the newest log hour, out of all hours written, asked for by the output hour it feeds."""
    root = fx.scratch(spark)
    newest = dt.datetime.strptime(catalogue.hours_of(fx.events(spark, d))[-1], "%Y%m%d%H") - dt.timedelta(hours=8)
    lines = fx.events(spark, d).select(F.to_json(F.struct("event_id", "k")).alias("value"), F.substring("hour", 1, 8).alias("datepart"), F.substring("hour", 9, 2).alias("hour"))
    lines.repartition("datepart", "hour").write.partitionBy("datepart", "hour").text(root)
    return logs.read_hour_lines(spark, root, newest.strftime("%Y%m%d%H")).select(F.from_json("value", "event_id bigint, k int").alias("e")).select("e.*")


def allow_list_read(spark, d):
    path = f"{fx.scratch(spark)}/apps"
    fx.events(spark, d).select("ad_package_name").write.text(path)
    return stores.read_allow_list(spark, path)


def entity_store_lookup(spark, d):
    """Counters of the users of the events from a bucketed entity store."""
    name = f"store_{uuid.uuid4().hex}"
    buckets = max(8, _user_tasks(spark, d))
    entries = export.user_counter_entries(_user_rows(spark, d, buckets), PUBLISHED_AT)
    prefix = F.lit(len(USER_COUNTER_KEY_PREFIX) + 1)
    entities = entries.select(F.substring("entity_key", prefix, F.length("entity_key")).alias("user_id"), F.col("value").alias("pb"))
    stores.write_entity_store(entities, name, buckets, f"{fx.scratch(spark)}/store", dealt=True)
    users = fx.table(spark, d, "events").select((F.col("user_id") * 5).cast("string").alias("user_id"))
    return stores.counters_of_users(users, name)


def paired_days(spark, d):
    """Each event with what its user did the day before."""
    root = fx.scratch(spark)
    rows = fx.events(spark, d).withColumn("dt", F.substring("hour", 1, 8))
    daily = rows.groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))
    daily.repartition("dt").write.partitionBy("dt").parquet(root)
    features = spark.read.schema("user_id bigint, n bigint, last bigint, dt string").parquet(root)
    return samples.pair_days(rows.select("event_id", "user_id", "dt"), features, ["user_id"])


def published_counters(spark, d):
    """Counters published in two versions, a refused one between them; readers get the last that passed."""
    root, rows = fx.scratch(spark), ad_counter_rollup(spark, d)
    publish.publish(rows.where("dim_set = 'ad_id'"), root)
    try:
        publish.publish(rows.withColumn("click", F.col("click") - 20), root)
    except publish.Refused:
        publish.publish(rows, root, partition_by=("dim_set",))
    return publish.read_published(spark, root, rows.schema)


# stream twins and publishing

def stream_events(spark, d):
    return stream.decode_events(fx.stream_lines(spark, d), ("app.one", "app.two"))


def stream_events_live(spark, d):
    """The same decoding run as a stream over the event table, file by file until all is read."""
    lines = fx.stream_lines(spark, d, fx.event_stream(spark, d))
    root = fx.scratch(spark)
    query = (
        stream.decode_events(lines, ("app.one", "app.two")).writeStream.format("parquet")
        .option("path", f"{root}/rows").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/rows")


def stream_flush_live(spark, d):
    """Decoded events flushed as TSV into five-minute buckets; the stream stops after half of the messages and goes on."""
    root = fx.scratch(spark)
    lines = fx.stream_lines(spark, d)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    for part in (lines.where(first), lines.where(~first)):
        part.select("value").write.mode("append").text(f"{root}/messages")
        messages = spark.readStream.text(f"{root}/messages")
        stream.write_buckets(stream.decode_events(messages, ("app.one", "app.two")), f"{root}/buckets", f"{root}/checkpoint", once=True).awaitTermination()
    return spark.read.schema("value string, bucket string").text(f"{root}/buckets").where(F.length("bucket") == 12).select("value")


def rolling_24h_live(spark, d):
    """The rolling counts as a stream with state and a watermark of six hours, stopped and started again between deliveries."""
    root = fx.scratch(spark)
    for part in fx.deliveries(spark, d):
        part.write.mode("append").parquet(f"{root}/events")
        source = spark.readStream.schema(part.schema).parquet(f"{root}/events")
        stream.write_rolling(source, ["ad_id"], f"{root}/rows", f"{root}/checkpoint", late="6 hours").awaitTermination()
    rows = spark.read.parquet(f"{root}/rows").where("ad_id >= 0")
    return rows.select(hour_of("window_end").alias("end_hour"), "ad_id", "n")


def rolling_24h(spark, d):
    return stream.rolling_day_counts(fx.events(spark, d), ["ad_id"]).select(hour_of("window_end").alias("end_hour"), "ad_id", "n")


def kv_export(spark, d):
    return export.user_counter_entries(_user_rows(spark, d), PUBLISHED_AT)


def kv_profile_export(spark, d):
    return export.user_profile_entries(_profiles(spark, d), PUBLISHED_AT)


def kv_lookup(spark, d):
    requests = fx.table(spark, d, "events").select("event_id", (F.col("user_id") * 5).cast("string").alias("user_id"))
    found = stores.lookup_users(requests, export.user_profile_entries(_profiles(spark, d), PUBLISHED_AT), USER_PROFILE_KEY_PREFIX)
    return found.select("event_id", "entity_key", "value")


def validate_export(spark, d):
    rows = ad_counter_rollup(spark, d)
    return export.invalid_counters(rows.select(
        "dim_set", "dim_key", F.when(F.col("window_tag") == "14d", "45d").otherwise(F.col("window_tag")).alias("window_tag"),
        (F.col("imp") * 100_000).alias("imp"), (F.col("click") - 20).alias("click"), "attr_install",
    ))


def artefact_manifest(spark, d):
    docs = ad_counter_documents(spark, d)
    lines = docs.select(F.substring_index("counter_key", "#", 1).alias("part"), F.concat_ws("\t", "counter_key", "value").alias("value"))
    return export.manifest(lines, by=("part",))


QUERIES = {f.__name__: f for f in (
    ad_counter_rollup, ad_counter_rollup_nation, user_counter_rollup, user_counter_rollup_nation,
    ad_counter_documents, ad_counter_documents_nation, counter_documents_read, global_totals,
    project_imp_click, project_install, imp_click_tsv, last_24_partitions, latest_snapshot, source_hours,
    hourly_recount, bj_day_install, counter_refresh, counter_merge_smooth, merged_views, wilson_scores,
    flatten_mixer_log, flatten_rec_log, flatten_req_ads, flatten_train_feature,
    user_profile, user_profile_base, ascii_guard, package_category, adinfo_overlay, adinfo_documents,
    train_sample_lookup, train_sample_nation, train_sample_logged, scored_labels,
    feature_label_counts, feature_counts_sparse, feature_index_lines, mi_ctr, mi_cvr, chi_square_stat, chi_square_uncorrected, chi_square_test,
    index_allocation, index_allocation_compact, encoded_examples,
    ctr_buckets, isotonic_model, calibrated_scores, calibrated_scores_inclusive, calibration_bias,
    auc, auc_signed, bid_weighted_auc,
    calibration_model_file, recount_from_files, catalogue_hours, hour_lines_read, log_hour_read, allow_list_read, entity_store_lookup, paired_days, published_counters,
    stream_events, stream_events_live, stream_flush_live, rolling_24h, rolling_24h_live, kv_export, kv_profile_export, kv_lookup, validate_export, artefact_manifest,
)}
