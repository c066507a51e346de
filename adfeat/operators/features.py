"""Feature analysis: counts per value and label, mutual information, chi-square, index sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from adfeat.functions.chi2 import chi2_p_value, chi2_quantile

# An extractor maps samples to rows (click, attr_install, int_features map<string,string>).
Extractor = Callable[[DataFrame], DataFrame]


def column_extractor(click: Column, attr_install: Column, features: dict[str, Column]) -> Extractor:
    """Extractor whose features are plain column expressions; missing values are left out."""

    def extract(samples: DataFrame) -> DataFrame:
        entries = F.create_map(*[x for name, c in features.items() for x in (F.lit(name), c.cast("string"))])
        return samples.select(
            click.alias("click"), attr_install.alias("attr_install"),
            F.map_filter(entries, lambda _, v: v.isNotNull()).alias("int_features"),
        )

    return extract


def native_extractor(fn, schema: str = "click int, attr_install int, int_features map<string,string>") -> Extractor:
    """Extractor around ``fn(iterator of pandas batches)``, for a library loaded inside the tasks."""
    return lambda samples: samples.mapInPandas(fn, schema)


def encoded_examples(samples: DataFrame, example: Column) -> DataFrame:
    """One base64 text line per sample of its binary training example.

    Long output of ``base64`` may come in MIME lines of 76 characters; the breaks are taken out."""
    return samples.select(F.translate(F.base64(example.cast("binary")), "\r\n", "").alias("value"))


def feature_label_counts(samples: DataFrame, extractor: Extractor) -> DataFrame:
    """Samples per ``(fea_k, fea_v, click, install)``; samples without features give nothing."""
    rows = extractor(samples).select("click", "attr_install", F.explode("int_features").alias("fea_k", "fea_v"))
    return rows.groupBy("fea_k", "fea_v", "click", F.col("attr_install").alias("install")).agg(
        F.count(F.lit(1)).alias("imp")
    )


def _two_class(counts: DataFrame, label: str) -> DataFrame:
    """Per feature value the weight of label 1 and label 0."""
    if label == "install":  # conversion is judged on clicked samples only
        counts = counts.where(F.col("click") > 0)
    hit = F.col(label)
    return counts.groupBy("fea_k", "fea_v").agg(
        F.sum(F.when(hit == 1, F.col("imp")).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(hit == 0, F.col("imp")).otherwise(0)).cast("double").alias("neg"),
    )


def _xlog2x(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def mutual_information(counts: DataFrame, label: str = "click") -> DataFrame:
    """``(feature, n_values, mi)`` in bits between a feature and ``click`` or ``install``.

    Written with sums of n·log2(n), so one aggregation per feature does: totals are neither joined
    back to the values nor needed beforehand. Null if a label class is empty.
    """
    both = F.col("pos") + F.col("neg")
    sums = _two_class(counts, label).groupBy(F.col("fea_k").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.sum("pos").alias("p"), F.sum("neg").alias("q"),
        F.sum(_xlog2x(F.col("pos")) + _xlog2x(F.col("neg")) - _xlog2x(both)).alias("cells"),
    )
    p, q = F.col("p"), F.col("q")
    mi = (F.col("cells") - _xlog2x(p) - _xlog2x(q) + _xlog2x(p + q)) / (p + q)
    return sums.select("feature", "n_values", F.when((p > 0) & (q > 0), mi).alias("mi"))


def chi_square(counts: DataFrame, label: str = "click", yates: bool = True) -> DataFrame:
    """``(feature, n_values, stat, dof)`` of the values × label table.

    ``stat`` is -1 if a class is empty or the feature has one value. With two values (one degree of
    freedom) each count is moved towards its expectation by up to one half, unless ``yates`` is off.

    The statistic is the weighted variance of the values' rates around the rate of the feature, so its sum is centred on totals: how far a
    value is off (pos·n - m·p) is a difference of whole numbers and loses nothing, whatever the counts. Totals come from the same
    shuffle of counts per value and are one row per feature.
    """
    values = _two_class(counts, label).withColumns({c: F.col(c).cast("decimal(18,0)") for c in ("pos", "neg")})
    values = values.withColumn("m", (F.col("pos") + F.col("neg")).cast("decimal(18,0)")).where(F.col("m") > 0)
    totals = values.groupBy("fea_k").agg(F.sum("pos").cast("decimal(18,0)").alias("p"), F.sum("m").cast("decimal(18,0)").alias("n"))
    off = F.col("pos") * F.col("n") - F.col("m") * F.col("p")  # less than 10^36
    far = off.cast("double")
    m, p, n = (F.col(c).cast("double") for c in ("m", "p", "n"))
    part = far * far / (m * p * (n - p))  # of the whole statistic
    gap = F.abs(far) / n
    moved = gap - F.least(gap, F.lit(0.5))
    sums = values.join(totals, "fea_k").groupBy(F.col("fea_k").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_values"), F.first("p").alias("p"), F.first("n").alias("n"),
        F.sum(F.when((p > 0) & (n > p), part)).alias("general"),
        # with two values both counts are off by the same, so both are moved by the same
        F.sum(F.when((p > 0) & (n > p), moved * moved * n * n / (m * p * (n - p)))).alias("corrected"),
    )
    stat = F.when((F.col("n_values") == 2) & F.lit(yates), F.col("corrected")).otherwise(F.col("general"))
    usable = (F.col("p") > 0) & (F.col("n") > F.col("p")) & (F.col("n_values") > 1)
    return sums.select(
        "feature", "n_values", F.when(usable, stat).otherwise(F.lit(-1.0)).alias("stat"),
        F.when(usable, F.col("n_values") - 1).alias("dof"),
    )


def chi_square_test(counts: DataFrame, label: str = "click", prob: float = 0.8) -> DataFrame:
    """:func:`chi_square` with the critical value at ``prob`` and the p-value, one Python call per feature, at any number of values."""
    return chi_square(counts, label).select(
        "feature", "n_values", "stat",
        chi2_quantile(F.lit(prob), F.col("dof").cast("double")).alias("critical"),
        chi2_p_value(F.when(F.col("dof").isNotNull(), F.col("stat")), F.col("dof").cast("double")).alias("p_value"),
    )


def index_allocation(counts: DataFrame, compact: bool = False) -> DataFrame:
    """Embedding index size per feature: ``(name, f1, size, type, f2, f3, f4)``; single-valued features are left out.

    ``compact`` selects the shorter rule list of the nation variant.
    """
    sizes = counts.groupBy("fea_k").agg(F.count_distinct("fea_v").alias("n")).where(F.col("n") > 1)
    name, n = F.col("fea_k"), F.col("n")

    def has(*parts: str) -> Column:
        cond = F.lit(False)
        for part in parts:
            cond = cond | name.contains(part)
        return cond

    # Feature names and the index sizes set for them, first match wins.
    if compact:
        size = (
            F.when(name == "ctx_ip", 100_000)
            .when(has("user_ad_uac", "ad_ac", "up_uc"), 10_000)
            .when(name == "ad_ai_cid", 10_000)
            .otherwise(n * 10)
        )
    else:
        size = (
            F.when(name == "up_uid", 200_000)
            .when(name == "ctx_ip", 100_000)
            .when(has("user_ad_uac", "ad_ac", "up_uc"), F.when(has("/"), 10_000).otherwise(5_000))
            .when(name == "ad_ai_cid", 10_000)
            .when(has("ad_ai_aid", "ad_ai_adid"), 3_000)
            .when(has("ctx_ad"), n * 3)
            .otherwise(n * 10)
        )
        sizes = sizes.where(name != "ctx_ne3")
    zero = F.lit(0)
    return sizes.select(
        name.alias("name"), zero.alias("f1"), size.cast("bigint").alias("size"), F.lit("int").alias("type"),
        zero.alias("f2"), zero.alias("f3"), zero.alias("f4"),
    )
