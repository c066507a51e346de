"""Training jobs: samples, feature analysis, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adfeat import schemas
from adfeat.config import MAIN, Variant
from adfeat.operators import calibration, features, ranking, samples
from adfeat.sinks import export
from adfeat.sources import logs, stores


def build_lookup_samples(
    labels: DataFrame, ad_counters: DataFrame, user_counters: DataFrame, profiles: DataFrame, out_path: str,
    feature_date: str, label_date: str, variant: Variant = MAIN,
) -> None:
    """Sample lines from the counters and profiles of ``feature_date``, which must precede the labels."""
    samples.check_dates(feature_date, label_date)
    out = samples.assemble_samples(labels, ad_counters, user_counters, profiles, variant)
    out.select(samples.sample_json().alias("value")).write.mode("errorifexists").text(out_path)


def build_logged_samples(spark: SparkSession, labels: DataFrame, feature_root: str, day: str, out_path: str, variant: Variant = MAIN) -> None:
    """Sample lines from the features logged on ``day``."""
    logged = logs.read_day_json(spark, feature_root, day, schemas.TRAIN_FEATURE)
    joined = samples.join_logged_features(labels, logged)
    joined.select(samples.logged_sample_json(variant=variant).alias("value")).write.mode("errorifexists").text(out_path)


def encode_samples(spark: SparkSession, sample_path: str, out_path: str, example: Column | None = None) -> None:
    """Base64 lines of the training examples; by default the example is the sample text itself."""
    lines = spark.read.text(sample_path)
    features.encoded_examples(lines, F.col("value") if example is None else example).write.mode("errorifexists").text(out_path)


def analyse_features(spark: SparkSession, sample_path: str, extractor: features.Extractor, out_root: str, compact: bool = False) -> None:
    """Label counts of the samples, then mutual information for clicks and conversions, chi-square and index sizes.

    The counts are written first and read back: everything after them works on that small table."""
    counts = features.feature_label_counts(spark.read.text(sample_path), extractor)
    export.write_tsv(counts.select("fea_k", "fea_v", "click", "install", "imp"), f"{out_root}/counts")
    counts = stores.read_tsv(spark, f"{out_root}/counts", schemas.FEATURE_COUNTS_TSV)
    for label, name in (("click", "mi_ctr"), ("install", "mi_cvr")):
        export.mutual_information_lines(features.mutual_information(counts, label)).write.text(f"{out_root}/{name}")
    export.write_tsv(features.chi_square_test(counts), f"{out_root}/chi_square")
    export.write_tsv(features.index_allocation(counts, compact), f"{out_root}/index")


def train_calibration(spark: SparkSession, rate_path: str, model_path: str) -> None:
    """Isotonic click-rate model of scored rows, as an ordered text file."""
    rows = stores.read_tsv(spark, rate_path, schemas.RATE_TSV)
    model = calibration.isotonic_model(calibration.ctr_buckets(rows))
    export.calibration_model_lines(model).write.mode("errorifexists").text(model_path)


def evaluate_calibration(spark: SparkSession, rate_path: str, model_path: str) -> DataFrame:
    """Mean calibrated score and mean label of scored rows (one row)."""
    rows = stores.read_tsv(spark, rate_path, schemas.RATE_TSV)
    return calibration.calibration_bias(rows, stores.read_calibration_model(spark, model_path))


def evaluate_ecpm(spark: SparkSession, ecpm_path: str) -> DataFrame:
    """Bid-weighted ranking quality of scored rows (one row)."""
    return ranking.bid_weighted_auc(ranking.ecpm_rows(stores.read_tsv(spark, ecpm_path, schemas.ECPM_TSV)))
