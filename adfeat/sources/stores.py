"""Entity stores, counter snapshots, lists and positional files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adfeat import schemas
from adfeat.config import MAIN, MEASURES, SLOT_PREFIX, USER_COUNTER_KEY_PREFIX, WINDOW_TAGS, Variant
from adfeat.functions.cells import cell_type
from adfeat.operators.skew import HOT_ROWS, join_hot
from adfeat.sources.logs import latest_snapshot, partition_values


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """``(user_id, pb)`` of JSON-line entities, ``pb`` staying JSON text."""
    return spark.read.schema("user_id string, pb string").json(path)


def write_entity_store(entities: DataFrame, table: str, buckets: int, path: str | None = None, dealt: bool = False) -> None:
    """Entities ``(user_id, pb)`` as a table bucketed and sorted by user.

    Lookups by user then shuffle their requests only, however often the store is asked: it lies as the join wants it. ``buckets``
    about one per 200 MB of the store, but no fewer than ``spark.sql.shuffle.partitions``: below that Spark shuffles both sides.

    ``dealt``: the rows lie by user over ``buckets`` tasks already, as those made from rows dealt out by
    :func:`adfeat.operators.counters.by_user` do, so the texts aren't shuffled; a row that lies elsewhere only costs a file more."""
    rows = entities.select("user_id", "pb")
    rows = rows if dealt else rows.repartition(buckets, "user_id")
    writer = rows.write.bucketBy(buckets, "user_id").sortBy("user_id").format("parquet").option("compression", "zstd")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def counters_of_users(requests: DataFrame, table: str, variant: Variant = MAIN) -> DataFrame:
    """User counters in long form of the users of ``requests`` (column ``user_id``), each once, from a bucketed entity store."""
    store = requests.sparkSession.table(table)
    asked = requests.select("user_id").distinct()
    return counters_of_entities(store.join(asked, "user_id", "left_semi"), variant)


def counters_of_entities(entities: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """User counters in long form from ``(user_id, pb)`` entities."""
    doc = F.from_json("pb", f"storeUserCounter map<string, {cell_type(variant.install_field)}>")
    cells = entities.select("user_id", F.explode(doc["storeUserCounter"]).alias("counter_key", "cell"))
    return _long_form(cells, variant, "user_id")


def counters_of_documents(documents: DataFrame, variant: Variant = MAIN) -> DataFrame:
    """Counters in long form from ``(counter_key, value)`` rows with the cell as JSON text."""
    cells = documents.select("counter_key", F.from_json("value", cell_type(variant.install_field)).alias("cell"))
    return _long_form(cells, variant)


def _long_form(cells: DataFrame, variant: Variant, *by: str) -> DataFrame:
    """Unpivot the window slots; the longest set name that starts the key is its dimension set."""
    names = dict(zip(MEASURES, ("imp", "click", variant.install_field)))
    slots = F.array(*[F.struct(F.lit(w).alias("window_tag"), F.col(f"cell.{SLOT_PREFIX}{w}").alias("c")) for w in WINDOW_TAGS])
    out = cells.select(*by, "counter_key", F.explode(F.filter(slots, lambda s: s["c"].isNotNull())).alias("s"))
    # a nation variant leads the key with the nation
    key = F.substring_index("counter_key", "#", 1) if variant.nation_prefix and not by else None
    rest = F.expr("substring(counter_key, length(substring_index(counter_key, '#', 1)) + 2)") if key is not None else F.col("counter_key")
    sets = sorted((variant.user_sets if by else variant.ad_sets), key=lambda s: -len(s.name))
    chosen = F.coalesce(*[F.when(F.startswith(rest, F.lit(s.name + "#")), F.lit(s.name)) for s in sets])
    return out.select(
        *by, *([key.alias("nation")] if key is not None else []),
        chosen.alias("dim_set"), rest.substr(F.length(chosen) + 2, F.length(rest)).alias("dim_key"), F.col("s.window_tag").alias("window_tag"),
        *[F.coalesce(F.col(f"s.c.{names[m]}"), F.lit(0)).alias(m) for m in MEASURES],
    )


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Counter snapshot in long form."""
    return spark.read.parquet(path)


def read_latest_counters(spark: SparkSession, root: str) -> DataFrame:
    """The newest daily counter snapshot under ``root`` (``dt=`` folders), without opening older ones."""
    rows = spark.read.parquet(root)
    return latest_snapshot(rows, values=partition_values(spark, root, "dt")).drop("dt")


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """Allow-list with one entry per line, as column ``app``."""
    return spark.read.text(path).select(F.col("value").alias("app")).distinct()


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Positional TSV; a row with a wrong number of fields or a bad value stops the job. An empty text field stays empty."""
    rows = spark.read.csv(path, sep="\t", schema=schema, mode="FAILFAST", quote="", escape="", enforceSchema=True)
    texts = {c for c, kind in rows.dtypes if kind == "string"}
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) if c in texts else F.col(c) for c in rows.columns])


def read_calibration_model(spark: SparkSession, path: str) -> DataFrame:
    """Model rows ``(bucket, n, clicks, prate, rate)`` from a file separated by spaces."""
    return spark.read.csv(path, sep=" ", schema=schemas.CALIBRATION_MODEL, mode="FAILFAST")


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of a query of a relational database; later filters are pushed into it."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **options).load()


def lookup_users(
    requests: DataFrame, entries: DataFrame, prefix: str = USER_COUNTER_KEY_PREFIX, hot_rows: int = HOT_ROWS, parts: int = 1
) -> DataFrame:
    """``requests`` (column ``user_id``) with the published value of each user; every request stays.

    Entries published in several ``parts`` give one row per part, without a value where a user has none."""
    key = F.concat(F.lit(prefix), F.col("user_id").cast("string"))
    wanted = requests.withColumn("entity_key", key)
    if parts > 1:
        ends = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        wanted = requests.withColumn("_end", ends).withColumn("entity_key", F.concat(key, F.lit("#"), F.col("_end").cast("string"))).drop("_end")
    found = entries.select("entity_key", "part", "value")
    return join_hot(wanted, found, ["entity_key"], "left", hot_rows)
