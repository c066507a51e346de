"""Joins that stay balanced when one key, or one row, makes up a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

HOT_ROWS = 2_000_000  # a key with at least this many rows is split over several tasks
# Only keys with more than one in so many of all rows are: there are no more of them, hence the list that is
# broadcast (two numbers a key) is at most 16 MB. Other keys hold too little to matter.
HOT_KEYS = 1_000_000
CHUNK = 100_000  # equal rows that travel as one
WORDS = 1 << 20  # marks of asked keys: so many words of 64 bits at most, two numbers each, hence as small as the list of hot keys
NULL_PIECES = 1 << 20  # rows without a key are dealt out over so many


def key_counts(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Rows per key, as ``(keys…, _n)``; ``weight`` names a column of earlier counts to add up."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(n.alias("_n"))


def counted_keys(counts: DataFrame) -> DataFrame:
    """The keys of :func:`key_counts`.

    The filter holds for every key. It keeps the counts in the plan, so that this reader and the one
    that looks for hot keys share one shuffle; without it Spark would plan a second one of bare keys.
    """
    return counts.where(F.col("_n") > 0).drop("_n")


def short_list(df: DataFrame, keys: list[str]) -> DataFrame:
    """The few rows left by a filter on a large aggregation, made ready to be broadcast.

    A broadcast must finish in ``spark.sql.broadcastTimeout``. The extra shuffle of the few rows moves
    the long work before it into a stage of its own, which has no such limit.
    """
    return df.repartition(8, *keys)


def perhaps_asked(rows: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose keys ``asked`` does not have; ahead of the exact semi join of the two.

    A bit for the hash of every asked key is broadcast, in :data:`WORDS` words at most, whatever the number of keys; the fewer
    the bits, the more rows go before they are shuffled or summed up. No row of an asked key goes. Keys of different or
    unusual types, which may be equal under different hashes, are let through. Keys should be plain columns: Spark may move
    the filter below a projection, and longer expressions are then worked out several times a row."""
    kinds = [dict(rows.dtypes)[k] for k in keys]
    if kinds != [dict(asked.dtypes)[k] for k in keys] or not {*kinds} <= {"string", "int", "bigint"}:
        return rows
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    word, bit = F.expr(f"pmod(shiftright({hashed}, 6), {WORDS}L)"), F.expr(f"shiftleft(1L, cast({hashed} & 63L AS int))")
    marks = short_list(asked.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), ["_word"])
    return rows.join(F.broadcast(marks), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0), "left_semi")


def comparable(value: Column, kind: DataType) -> Column:
    """The value in a form that can be hashed and grouped, equal for equal values: maps as sorted entries, variants as text."""
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(
            comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(pairs)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        made = F.struct(*[comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), made)
    return F.to_json(value) if isinstance(kind, VariantType) else value


def chunked(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Equal rows as one row per ``chunk`` of them at most, with ``_times`` (how many it stands for) and ``_hash``.

    They are counted where they are read before they are shuffled, so that a row repeated without end is no more work
    than others. ``_hash`` differs between the pieces of a row."""
    forms = [comparable(F.col(c), df.schema[c].dataType) for c in df.columns]
    digest = F.xxhash64(*forms).alias("_digest")
    if any(_needs_form(df.schema[c].dataType) for c in df.columns):  # grouped by what they come to; equal rows are any of them
        keys = [form.alias(f"_g{i}") for i, form in enumerate(forms)]
        counted = df.groupBy(*keys, digest).agg(F.any_value(F.struct(*df.columns)).alias("_row"), F.count(F.lit(1)).alias("_c")).select("_row.*", "_digest", "_c")
    else:
        counted = df.groupBy(*df.columns, digest).agg(F.count(F.lit(1)).alias("_c"))
    cut = counted.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_c") - 1) / chunk))))
    times = F.least(F.lit(chunk), F.col("_c") - F.col("_piece") * chunk).cast("int")
    return cut.select(*df.columns, times.alias("_times"), F.xxhash64("_digest", "_piece").alias("_hash"))


def _needs_form(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_needs_form(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _needs_form(kind.elementType)
    return isinstance(kind, (MapType, VariantType))


def repeated(df: DataFrame) -> DataFrame:
    """Rows of :func:`chunked` as often as they stand for."""
    return df.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_again", "_times")


def _hot_keys(counts: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """``(_k, _pieces)`` of the hot keys. The hash of a key stands for it: another key of the same hash is split as well, on both sides."""
    total = counts.agg(F.sum("_n").alias("all")).scalar()
    hot = counts.where((F.col("_n") >= hot_rows) & (F.col("_n") * HOT_KEYS > total))
    pieces = F.ceil(F.sum("_n") / hot_rows).cast("int").alias("_pieces")
    return short_list(hot.groupBy(F.xxhash64(*keys).alias("_k")).agg(pieces), ["_k"])


def _marked(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    return df.withColumn("_k", F.xxhash64(*keys)).join(F.broadcast(hot), "_k", "left").drop("_k")


def _no_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _copies(right: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    pieces = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    return _marked(right, keys, hot).withColumn("_salt", F.explode(pieces)).drop("_pieces")


def join_packed(
    packed: DataFrame, right: DataFrame, keys: list[str], how: str = "left", hot_rows: int = HOT_ROWS, counts: DataFrame | None = None
) -> DataFrame:
    """:func:`join_hot` for rows of :func:`chunked`, or rows that differ and have a ``_hash``; it stays for further joins.

    ``counts`` are those of the rows that the chunks stand for."""
    assert how in ("inner", "left")
    hot = _hot_keys(key_counts(packed, keys) if counts is None else counts, keys, hot_rows)
    spread = F.coalesce(F.col("_pieces"), F.when(_no_key(keys), NULL_PIECES))  # a null key never matches
    salt = F.when(spread.isNotNull(), F.pmod("_hash", spread.cast("bigint")).cast("int")).otherwise(0)
    salted = _marked(packed, keys, hot).withColumn("_salt", salt).drop("_pieces")
    return salted.join(_copies(right, keys, hot), [*keys, "_salt"], how).drop("_salt")


def join_hot(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    counts: DataFrame | None = None,
    chunk: int | None = CHUNK,
) -> DataFrame:
    """``left.join(right, keys, how)`` for ``inner`` and ``left``, with the hot keys of ``left`` split.

    ``counts`` are the :func:`key_counts` of ``left`` if the caller has them already; otherwise
    they cost one more aggregation of ``left``, combined map-side.

    Rows of a hot key are counted and cut into chunks (:func:`chunked`); the chunks are dealt out by a hash of the row and
    the number of the chunk (repeatable, so a lost task can be recomputed), only the matching right rows are
    repeated, once per piece, and the joined rows then as often as they were there. Rows with a null key never match;
    they are dealt out in the same way, as they would all land in one task. ``chunk`` None: no two rows are equal, so their hashes
    alone deal them out and nothing is counted.

    Adaptive skew handling alone would not do: it cannot split a join whose other side is an
    aggregation on the same keys, which is the usual case for lookups.
    """
    assert how in ("inner", "left")
    if chunk is None:
        digest = F.xxhash64(*[comparable(F.col(c), left.schema[c].dataType) for c in left.columns])
        return join_packed(left.withColumn("_hash", digest), right, keys, how, hot_rows, counts).drop("_hash")
    hot = _hot_keys(key_counts(left, keys) if counts is None else counts, keys, hot_rows)
    # One condition on both sides of the join with hot: it is not pushed below, and both branches read the same shuffles of left.
    rows = _marked(left, keys, hot).withColumn("_spread", F.coalesce("_pieces", F.when(_no_key(keys), NULL_PIECES))).drop("_pieces")
    usual = rows.where(F.col("_spread").isNull()).drop("_spread").withColumns({"_times": F.lit(1), "_salt": F.lit(0)})
    packed = chunked(rows.where(F.col("_spread").isNotNull()), chunk)
    split = packed.withColumn("_salt", F.pmod("_hash", F.col("_spread").cast("bigint")).cast("int")).drop("_hash", "_spread")
    return repeated(usual.unionByName(split).join(_copies(right, keys, hot), [*keys, "_salt"], how).drop("_salt"))
