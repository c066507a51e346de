"""Command line of the scheduled jobs, for spark-submit.

    spark-submit --py-files adfeat.zip jobs.py ad-counters --table db.ad_accu --day 20240130 --root /model/ad_counter
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession, functions as F

from adfeat.config import MAIN, NATION
from adfeat.operators import features
from adfeat.plans import daily, hourly, training
from adfeat.sinks import publish
from adfeat.sources import stores, warehouse
from adfeat.streaming import events

VARIANTS = {v.name: v for v in (MAIN, NATION)}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, optional: tuple[str, ...] = ()) -> None:
        p = jobs.add_parser(name)
        for arg in required:
            p.add_argument(f"--{arg}", required=True)
        for arg in optional:
            p.add_argument(f"--{arg}")
        p.add_argument("--variant", choices=VARIANTS, default="main")

    job("flatten-log", "kind", "raw", "out", "hour", optional=("table",))
    job("imp-click", "log", "out", "hour", "packages")
    job("install", "log", "out", "hour", "packages", "flag")
    job("ad-counters", "table", "day", "root")
    job("user-counters", "table", "day", "root", optional=("tag", "nation"))
    job("profiles", "base", "day", "root", optional=("behaviour", "allow-list"))
    job("ad-info", "apps", "creatives", "campaigns", "day", "root", "as-of")
    job("refresh", "snapshot", "imp-click", "install", "out", "now", "exclude")
    job("refresh-published", "snapshot-root", "imp-click", "install", "root", "now", "exclude")
    job("merge", "snapshot", "hourly", "day", "root")
    job("merge-published", "snapshot", "hourly", "root")
    job("publish", "user-counters", "profiles", "day", "root", "published-at")
    job("samples", "labels", "ad-counters", "user-counters", "profiles", "label-day", "out", optional=("feature-day", "packages", "nation"))
    job("logged-samples", "labels", "features", "day", "out", optional=("packages",))
    job("encode", "samples", "out")
    job("analyse-features", "samples", "features", "out")
    job("stream-events", "packages", "out", "checkpoint", optional=("servers", "topic", "messages"))
    job("train-calibration", "rates", "out")
    job("evaluate-calibration", "rates", "model")
    job("evaluate-ecpm", "rates")
    return top


def iso(day: str) -> str:
    return dt.datetime.strptime(day, "%Y%m%d").date().isoformat()


def day_before(day: str) -> str:
    return (dt.datetime.strptime(day, "%Y%m%d") - dt.timedelta(days=1)).strftime("%Y%m%d")


def json_extractor(named: str) -> features.Extractor:
    """Extractor of sample lines: ``name=path`` pairs separated by commas, paths below the sample's document."""
    at = lambda path: F.get_json_object("value", f"$.{path}")
    pairs = dict(pair.split("=", 1) for pair in named.split(","))
    labels = [at(f"label.{name}").cast("int") for name in ("click", "attrInstall", "install")]
    return features.column_extractor(labels[0], F.coalesce(*labels[1:]), {name: at(path) for name, path in pairs.items()})


def stream(spark: SparkSession, a: argparse.Namespace) -> None:
    """Decode events and flush them every five minutes: of a topic without end, or of the message files of a folder until all are read."""
    if not a.messages and not (a.servers and a.topic):
        raise SystemExit("stream-events needs --servers and --topic, or --messages")
    raw = spark.readStream.text(a.messages) if a.messages else events.read_events(spark, a.servers, a.topic)
    decoded = events.decode_events(raw, a.packages.split(","))
    events.write_buckets(decoded, a.out, a.checkpoint, once=bool(a.messages)).awaitTermination()


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    variant = VARIANTS[a.variant]
    packages = a.packages.split(",") if getattr(a, "packages", None) else None
    read = spark.read.parquet
    match a.job:
        case "flatten-log":
            hourly.flatten_log_hour(spark, a.kind, a.raw, a.out, a.hour, a.table)
        case "imp-click":
            hourly.project_imp_click_hour(spark, a.log, a.out, a.hour, packages)
        case "install":
            hourly.project_install_hour(spark, a.log, a.out, a.hour, packages, a.flag)
        case "ad-counters":
            daily.build_ad_counters(warehouse.read_accu(spark, a.table, a.day), a.root, a.day, variant)
        case "user-counters":
            daily.build_user_counters(warehouse.read_accu(spark, a.table, a.day, a.tag, a.nation), a.root, a.day, variant)
        case "profiles":
            behaviour = warehouse.read_behaviour(spark, a.behaviour, a.day) if a.behaviour else None
            allowed = stores.read_allow_list(spark, a.allow_list) if a.allow_list else None
            daily.build_user_profiles(warehouse.read_user_base(spark, a.base), behaviour, allowed, a.root, a.day, variant)
        case "ad-info":
            apps, creatives, campaigns = (spark.table(t) for t in (a.apps, a.creatives, a.campaigns))
            daily.build_ad_info(apps, creatives, campaigns, a.root, a.day, dt.datetime.fromisoformat(a.as_of))
        case "refresh":
            now = dt.datetime.strptime(a.now, "%Y%m%d%H")
            bad = hourly.refresh_counters_hour(spark, read(a.snapshot), a.imp_click, a.install, a.out, now, a.exclude)
            if not bad.isEmpty():
                raise SystemExit("counters out of range, see adfeat.sinks.export.invalid_counters")
        case "refresh-published":
            now = dt.datetime.strptime(a.now, "%Y%m%d%H")
            daily_counters = stores.read_latest_counters(spark, a.snapshot_root)
            refused(lambda: hourly.publish_refresh(spark, daily_counters, a.imp_click, a.install, a.root, now, a.exclude))
        case "merge-published":
            refused(lambda: daily.publish_merged(read(a.snapshot), read(a.hourly), a.root, variant=variant))
        case "analyse-features":
            training.analyse_features(spark, a.samples, json_extractor(a.features), a.out, compact=variant is NATION)
        case "stream-events":
            stream(spark, a)
        case "merge":
            daily.merge_counters(spark, read(a.snapshot), read(a.hourly), a.root, a.day)
        case "publish":
            daily.publish_users(read(a.user_counters), read(a.profiles), a.root, a.day, int(a.published_at), variant)
        case "samples":
            labels = warehouse.read_labels(spark, a.labels, a.label_day, packages, a.nation)
            feature_day = a.feature_day or day_before(a.label_day)
            training.build_lookup_samples(
                labels, read(a.ad_counters), read(a.user_counters), read(a.profiles), a.out, iso(feature_day), iso(a.label_day), variant
            )
        case "logged-samples":
            labels = warehouse.read_labels(spark, a.labels, a.day, packages)
            training.build_logged_samples(spark, labels, a.features, a.day, a.out, variant)
        case "encode":
            training.encode_samples(spark, a.samples, a.out)
        case "train-calibration":
            training.train_calibration(spark, a.rates, a.out)
        case "evaluate-calibration":
            training.evaluate_calibration(spark, a.rates, a.model).show(truncate=False)
        case "evaluate-ecpm":
            training.evaluate_ecpm(spark, a.rates).show(truncate=False)


def refused(publishing) -> None:
    """Run it; what its check refuses ends the job, and readers keep the version before."""
    try:
        publishing()
    except publish.Refused as why:
        raise SystemExit(f"not published: {why}") from None


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(SparkSession.builder.appName(args.job).getOrCreate(), args)


if __name__ == "__main__":
    main()
