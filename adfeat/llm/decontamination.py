"""Benchmark decontamination by winnowing, native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import cut, few, let, lower_words, on_doc, small, text_key, upto

WINDOW = 13  # words of a benchmark window; shorter items are one window


def shape(n: int) -> tuple[int, int]:
    """Words of a fingerprint and fingerprints of a winnowing window, so that every n shared words hold a shared fingerprint."""
    k = (n + 2) // 2
    return k, n - k + 1


def grams(hashes: Column, k: int, n: int) -> Column:
    """Hash of the k words from each place on; n keeps fingerprints of different window lengths apart."""
    return F.transform(upto(F.size(hashes) - (k - 1)), lambda i: F.xxhash64(F.lit(n), *[F.get(hashes, i + j) for j in range(k)]))


def minima(hashes: Column, n: int) -> Column:
    """The winnowed fingerprints: the least k-gram hash of each winnowing window, each value once."""
    k, w = shape(n)
    least = lambda h: F.transform(
        upto(F.size(h) - (w - 1)), lambda i: F.least(*[F.get(h, i + j) for j in range(w)]) if w > 1 else F.get(h, i))
    return F.array_distinct(let(grams(hashes, k, n), least))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def fingerprints(words: Column, lengths: list[int]) -> Column:
    return let(word_hashes(words), lambda h: F.concat(*[minima(h, n) for n in lengths]))


def windows_at(words: Column, hits: Column, lengths: list[int]) -> Column:
    """Windows (n, start, words as text) around every place whose k-gram hash is among the hits: the hit, extended both ways."""

    def one(h: Column, n: int) -> Column:
        k, _ = shape(n)
        places = let(grams(h, k, n), lambda g: F.filter(upto(F.size(g)), lambda p: F.array_contains(hits, F.get(g, p))))
        around = F.flatten(F.transform(places, lambda p: F.sequence(F.greatest(p - (n - k), F.lit(0)), p)))
        starts = F.filter(F.array_distinct(around), lambda s: s + n <= F.size(words))
        return F.transform(starts, lambda s: F.struct(F.lit(n).alias("n"), s.alias("start"), F.array_join(F.slice(words, s + 1, n), " ").alias("window")))

    return let(word_hashes(words), lambda h: F.concat(*[one(h, n) for n in lengths]))


def covered(spans: Column) -> Column:
    """Number of places inside any span (start, n)."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
        (acc["count"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(s["start"], acc["end"]))).alias("count"))
    return F.aggregate(F.sort_array(spans), F.struct(F.lit(0).alias("end"), F.lit(0).alias("count")), step, lambda acc: acc["count"])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, n, window): all windows of the items, a window of n words as text; one row per item and window."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), lower_words(F.col("text")).alias("words"))
    sized = words.filter(F.size("words") > 0).withColumn("n", F.least(F.size("words"), F.lit(window)))
    each = sized.select("item", "n", F.explode(F.transform(
        upto(F.size("words") - F.col("n") + 1), lambda i: F.array_join(F.slice(F.col("words"), i + 1, F.col("n")), " "))).alias("window"))
    return each.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hit words and items of each document.

    Both sides are winnowed: of each run of consecutive k-gram hashes the least is kept, so that a shared span of a whole
    window always leaves a shared fingerprint. Documents' fingerprints meet the benchmark's in an equality join; around the
    hits, whole windows are compared as text, so nothing rests on hashes alone. Items of fewer than `window` words are one
    window of their own length and have fingerprints of that length.

    Columns: doc_id, text_key, n_words, n_hit, n_items, items (sorted), contaminated (5 % of the words are hit). Null or empty
    texts have no words and are clean; rows equal in doc_id and text come out once; null doc_ids are kept; an empty benchmark
    hits nothing; other columns are ignored. Items of a null item_id count as item "null", items of equal id are one item.
    """
    windows = cut(few(item_windows(benchmark, window)))
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most `window` rows
    base = docs.select("doc_id", "text", text_key().alias("text_key"))
    empty = F.array().cast("array<struct<n:int,start:int,window:string>>")
    if lengths:
        # A window of n words is winnowed as a text of its own: its one fingerprint is what a document with that window keeps.
        prints = cut(few(windows.select(F.explode(fingerprints(F.split("window", " "), lengths)).alias("print")).distinct()))
        rows = prints.count()
        found = base.select("doc_id", "text_key", F.explode(fingerprints(lower_words(F.col("text")), lengths)).alias("print"))
        hits = cut(few(found.join(small(prints, rows, 16), "print").groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("hits"))))
        size = hits.agg(F.count("*").alias("n"), F.sum(F.size("hits")).alias("prints")).first()
        joined = on_doc(base, hits, size=64 * size["n"] + 8 * (size["prints"] or 0)).select("doc_id", "text_key", lower_words(F.col("text")).alias("words"), "hits")
        spots = F.when(F.col("hits").isNotNull(), windows_at(F.col("words"), F.col("hits"), lengths)).otherwise(empty)
    else:
        joined, spots = base.select("doc_id", "text_key", lower_words(F.col("text")).alias("words")), empty
    spread = joined.select("doc_id", "text_key", F.size("words").alias("n_words"), F.explode_outer(spots).alias("spot"))
    # Documents without a candidate get a window of their own that meets nothing, so that they don't gather at one key.
    spread = spread.select("doc_id", "text_key", "n_words", F.col("spot.n").alias("n"), F.col("spot.start").alias("start"),
                           F.coalesce("spot.window", F.concat(F.lit("\n"), F.col("text_key").cast("string"))).alias("window"))
    met = spread.join(small(windows.select("window", "item"), windows.count(), 256), "window", "left")
    hit = F.when(F.col("item").isNotNull(), F.struct("start", "n"))
    per_doc = met.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"), F.collect_set(hit).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    counted = per_doc.select("doc_id", "text_key", "n_words", covered(F.col("spans")).cast("long").alias("n_hit"),
                             F.size("items").cast("long").alias("n_items"), "items")
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
