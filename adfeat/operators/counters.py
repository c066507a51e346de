"""Counter rollups over dimension sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adfeat.config import MAIN, MEASURES, DimSet, Variant
from adfeat.functions.cells import cell, window_sums
from adfeat.functions.keys import counter_key, dim_key, is_ascii, keyed_sets

TASK_ROWS = 100_000  # input rows of user counters in a task: nine sets of them take about 300 MB while they are summed up


def rollup(rows: DataFrame, sets: tuple[DimSet, ...], by: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregate ``rows`` once per dimension set, in one GROUPING SETS pass.

    The input is read once, expanded and combined map-side, so a hot dimension value reaches its
    reducer as one row per map task. Grouping happens on the native column types; key text is built
    from the much smaller result. Returns ``by + [dim_set, dim_key] + aggs``.
    """
    dims = list(dict.fromkeys(d for s in sets for d in s.dims if d not in by))
    cols = [*by, *dims]
    grouped = rows.groupingSets([[*by, *[d for d in s.dims if d not in by]] for s in sets], *cols).agg(
        F.grouping_id().alias("_gid"), *aggs
    )

    def gid(s: DimSet) -> int:
        return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in by and c not in s.dims)

    # one key builder per grouping id; the id tells a grouped-out column from a missing value
    names = F.create_map(*[x for s in sets for x in (F.lit(gid(s)), F.lit(s.name))])
    keys = reduce(lambda acc, s: acc.when(F.col("_gid") == gid(s), dim_key(s.dims)), sets, F)
    out = [c for c in grouped.columns if c not in cols and c != "_gid"]
    return grouped.select(*by, names[F.col("_gid").cast("int")].alias("dim_set"), keys.alias("dim_key"), *out)


def measure_sums() -> list[Column]:
    """Sums of the accumulated measures; missing counts are zero and totals never go negative."""
    return [
        F.greatest(F.coalesce(F.sum(m).cast("bigint"), F.lit(0)), F.lit(0)).alias(m) for m in MEASURES
    ]


def ad_counters(accu: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """Ad counters ``([nation,] window_tag, dim_set, dim_key, imp, click, attr_install)``.

    ``accu`` holds pre-accumulated counts ``(window_tag, dims…, imp, click, attr_install)``.
    """
    by = (["nation"] if variant.nation_prefix else []) + ["window_tag"]
    return rollup(accu, variant.ad_sets, by, measure_sums())


def user_dims(variant: Variant = MAIN) -> list[str]:
    """Columns besides the user that the user dimension sets are made of."""
    return list(dict.fromkeys(d for s in variant.user_sets for d in s.dims if d != "user_id"))


def user_tasks(spark: SparkSession, n_rows: int) -> int:
    """Tasks for user counters of so many input rows: ``spark.sql.shuffle.partitions``, more where that would leave a task too many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // TASK_ROWS))


def by_user(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows dealt out by user over ``tasks`` (:func:`user_tasks`; by default ``spark.sql.shuffle.partitions``).

    All that is grouped by user and more afterwards stays in its task, so rows may be multiplied by dimension sets
    without being shuffled. The number is given: adaptive execution would merge tasks by what the narrow rows take, not by what they become."""
    return rows.repartition(tasks or user_tasks(rows.sparkSession, 0), "user_id")


def user_counter_rows(accu: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """One row per input row and user dimension set, not yet added up: ``(user_id, window_tag, dim_set, dim_key, measures)``.

    Whatever sums counters up itself (:func:`counter_cells`, and with it samples and published
    entries) may take these rows in place of :func:`user_counters`. From rows dealt out :func:`by_user` they are summed up without a shuffle.
    """
    rows = accu.select("user_id", "window_tag", *MEASURES, F.explode(keyed_sets(variant.user_sets)).alias("s"))
    out = rows.select("user_id", "window_tag", "s.dim_set", "s.dim_key", *MEASURES)
    return out.where(is_ascii("dim_key")) if variant.ascii_dims_only else out


def user_counters(accu: DataFrame, variant: Variant = MAIN, tasks: int | None = None) -> DataFrame:
    """User counters ``(user_id, window_tag, dim_set, dim_key, imp, click, attr_install)``.

    A user's keys hardly repeat, so unlike in :func:`rollup` little would be combined before a shuffle of
    the keys: the narrow input rows are shuffled instead, once, by user, and multiplied by the sets after it.
    """
    rows = user_counter_rows(by_user(accu.select("user_id", "window_tag", *user_dims(variant), *MEASURES), tasks), variant)
    return rows.groupBy("user_id", "window_tag", "dim_set", "dim_key").agg(*measure_sums())


def event_counters(imp_click: DataFrame, installs: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """Row counts of recent events over the dimension sets without a category, as window ``1d``.

    Both inputs carry the dimension columns; ``imp_click`` has ``event_name`` besides. Show and
    click names are told apart by substring, other names are dropped.
    """
    sets = tuple(s for s in variant.ad_sets if "category" not in s.name)
    dims = list(dict.fromkeys(d for s in sets for d in s.dims))
    name = F.col("event_name")
    kind = F.when(name.contains("Show"), "imp").when(name.contains("Click"), "click")
    events = (
        imp_click.select(*dims, kind.alias("kind")).where(F.col("kind").isNotNull())
        .unionByName(installs.select(*dims, F.lit("attr_install").alias("kind")))
        .withColumn("window_tag", F.lit("1d"))
    )
    return rollup(events, sets, ["window_tag"], [F.count_if(F.col("kind") == m).alias(m) for m in MEASURES])


def local_day_installs(installs: DataFrame, begin_hour: str, end_hour: str) -> DataFrame:
    """Installs per ad within ``[begin_hour, end_hour)``, as window ``Bj1d``."""
    day = installs.where((F.col("hour") >= begin_hour) & (F.col("hour") < end_hour)).withColumn("window_tag", F.lit("Bj1d"))
    zero = F.lit(0).cast("bigint")
    counts = rollup(day, (DimSet("ad_id"),), ["window_tag"], [F.count(F.lit(1)).alias("attr_install")])
    return counts.select("window_tag", "dim_set", "dim_key", zero.alias("imp"), zero.alias("click"), "attr_install")


def counter_cells(counters: DataFrame, variant: Variant = MAIN, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per key with all its window slots in a nested ``cell``; several rows of a slot are added up."""
    keys = [*by, "dim_set", "dim_key"]
    return counters.groupBy(*keys).agg(*window_sums()).select(*keys, cell(variant.install_field).alias("cell"))


def counter_documents(counters: DataFrame, variant: Variant = MAIN, by: tuple[str, ...] = ()) -> DataFrame:
    """Published form: ``(counter_key, value)`` with the cell as JSON text, zero counts left out."""
    nation = "nation" if "nation" in by else None
    return counter_cells(counters, variant, by).select(
        *[b for b in by if b != "nation"],
        counter_key(nation=nation).alias("counter_key"),
        F.to_json("cell").alias("value"),
    )


def window_totals(counters: DataFrame) -> DataFrame:
    """Total impressions and installs of the ``7d`` category counters (one row)."""
    return counters.where((F.col("dim_set") == "ad_package_category") & (F.col("window_tag") == "7d")).agg(
        F.coalesce(F.sum("imp"), F.lit(0)).alias("all_imp"),
        F.coalesce(F.sum("attr_install"), F.lit(0)).alias("all_install"),
    )
