"""Ranked lexical search over hashed max-sketches.

Each document folds what its terms add to a score into a sketch: the greatest such impact per hashed coordinate. Looking up the
terms of all queries in a sketch bounds the document's scores from above. The documents of the highest bounds are scored exactly, which
gives a threshold per query; then every document whose bound reaches it is scored exactly too.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeat.llm.common import cut, saved, small
from adfeat.llm.encoding import frugal

TOP = 10
SIZE = 4096  # coordinates of a sketch
FREQUENT = 200_000  # terms in more than one of so many (document, term) pairs are looked up with their weight: no more than so many are
FLUSH = 200_000  # terms that a task counts before it gives them on
ITEMS = 256  # queries looked up together
AHEAD = 4 * TOP  # documents of the highest bounds that set the threshold of a query

_BREAKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_LOWER = bytes.maketrans(_BREAKS + bytes(range(0x41, 0x5B)), b" " * len(_BREAKS) + bytes(range(0x61, 0x7B)))


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    return text.translate(_LOWER).split()


class Corpus(NamedTuple):
    """Documents with a term, and all their terms."""

    docs: int
    terms: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))

    def length(self, n: int) -> int:
        return 100 - 75 + (75 * n * self.docs) // self.terms

    @property
    def heaviest(self) -> int:
        return self.weight(1)

    @property
    def unit(self) -> int:
        """An impact in a sketch is a number of 16 bits, rounded up to multiples of this."""
        return max(1, -(-self.heaviest * MOST // 65_535))


MOST = 1_000_000  # what a term adds is less than this times its weight


def part(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, df, total) of the texts of a task; the row of the empty term has the documents with terms and all their terms."""

    def given(found: Counter, docs: int, total: int) -> pa.RecordBatch:
        columns = [pa.array([b"", *found], pa.binary()), pa.array([docs, *found.values()], pa.int64()), pa.array([total] + [0] * len(found), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["term", "df", "total"])

    found, docs, total = Counter(), 0, 0
    for batch in batches:
        for text in batch.column("text"):
            words = terms(text.as_py())
            found.update(set(words))
            docs, total = docs + bool(words), total + len(words)
            if len(found) >= FLUSH:
                yield given(found, docs, total)
                found, docs, total = Counter(), 0, 0
    yield given(found, docs, total)


def folded(corpus: Corpus, weights, size: int) -> Callable:
    """Sketches: coordinates in use and their greatest impacts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rare, unit = weights.value, corpus.heaviest, corpus.unit
        for batch in batches:
            places, impacts, ends = [], [], [0]
            for text in batch.column("text"):
                words = terms(text.as_py())
                m = corpus.length(len(words)) if words else 0
                sketch: dict[int, int] = {}
                for term, tf in Counter(words).items():
                    place, impact = zlib.crc32(term) % size, known.get(term, rare) * part(tf, m)
                    if impact > sketch.get(place, 0):
                        sketch[place] = impact
                places.extend(sketch), impacts.extend(-(-x // unit) for x in sketch.values()), ends.append(len(places))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (places, impacts)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], names=["row", "places", "impacts"])

    return task


class Block:
    """Some queries: their terms, weights and repeats."""

    def __init__(self, items: list[tuple[int, dict[bytes, int]]], weights: dict[bytes, int], corpus: Corpus, size: int):
        self.numbers = [number for number, _ in items]
        self.terms = sorted({t for _, found in items for t in found if t in weights})
        self.index = {t: k for k, t in enumerate(self.terms)}
        self.weights = np.array([weights[t] for t in self.terms], np.int64)
        self.places = np.array([zlib.crc32(t) % size for t in self.terms], np.int64)
        self.repeats = np.zeros((len(self.terms), len(items)), np.int64)
        for j, (_, found) in enumerate(items):
            for term, times in found.items():
                if term in self.index:
                    self.repeats[self.index[term], j] = times
        self.caps = -(-self.weights * MOST // corpus.unit)  # no document has more of a term
        self.size = size

    def bounds(self, batch: pa.RecordBatch) -> np.ndarray:
        """Documents x queries, in units."""
        lists = batch.column("places")
        at = lists.offsets.to_numpy()
        dense = np.zeros((batch.num_rows, self.size))
        rows = np.repeat(np.arange(batch.num_rows), np.diff(at))
        dense[rows, lists.flatten().to_numpy()] = batch.column("impacts").flatten().to_numpy()
        return np.minimum(dense[:, self.places], self.caps) @ self.repeats.astype(float)

    def scores(self, text: bytes, corpus: Corpus) -> np.ndarray:
        """Exact scores for all queries."""
        words = terms(text)
        held = Counter(t for t in words if t in self.index)
        if not held:
            return np.zeros(len(self.numbers), np.int64)
        m, at = corpus.length(len(words)), [self.index[t] for t in held]
        impacts = self.weights[at] * np.array([part(tf, m) for tf in held.values()], np.int64)
        return impacts @ self.repeats[at]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def highest(block: Block, n: int) -> Callable:
    """The n highest bounds of each query in a task: (item, row, bound)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in block.numbers]
        for batch in slices(batches):
            bounds, rows = block.bounds(batch), batch.column("row").to_pylist()
            for j, heap in enumerate(best):
                column = bounds[:, j]
                least = heap[0][0] if len(heap) == n else 0
                for k in np.flatnonzero(column > least).tolist():
                    (heapq.heappushpop if len(heap) == n else heapq.heappush)(heap, (column[k], rows[k]))
        found = [(number, row, bound) for number, heap in zip(block.numbers, best) for bound, row in heap]
        items, rows, bounds = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(rows, pa.int64()), pa.array(bounds, pa.float64())], names=["item", "row", "bound"])

    return task


def reaching(block: Block, thresholds: dict[int, int], unit: int) -> Callable:
    """(row, items): the queries whose threshold a document's bound reaches."""
    least = np.array([thresholds.get(number, 0) for number in block.numbers], float)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bounds = block.bounds(batch)
            hit = (bounds > 0) & (bounds * unit >= least)
            some = np.flatnonzero(hit.any(axis=1))
            offsets = np.concatenate([[0], np.cumsum(hit[some].sum(axis=1))])
            items = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.nonzero(hit[some])[1], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(some, pa.int64())), items], names=["row", "places"])

    return task


def exact(block: Block, corpus: Corpus) -> Callable:
    """(item, doc_id, score) of the documents, by their texts; per query and task the TOP best are enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ids, scores = [], [], []
        kind = None

        def best() -> None:
            order = sorted(range(len(items)), key=lambda k: (items[k], -scores[k], ids[k] is None, *([] if ids[k] is None else [ids[k]])))
            seen, kept = Counter(), []
            for k in order:
                seen[items[k]] += 1
                if seen[items[k]] <= TOP:
                    kept.append(k)
            items[:], ids[:], scores[:] = ([x[k] for k in kept] for x in (items, ids, scores))

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("places")):
                made = block.scores(text.as_py(), corpus)
                for k in places.as_py():
                    if made[k] > 0:
                        items.append(block.numbers[k]), ids.append(doc_id), scores.append(int(made[k]))
                if len(items) > 40 * TOP * len(block.numbers):
                    best()
        best()
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return task


def ranked(scores: DataFrame, top: int = TOP) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, size: int = SIZE, block_items: int = ITEMS, frequent: int = FREQUENT) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the TOP best documents of each item, ties by ascending doc_id (null last).

    Every document is in the index; results are exact, as sketches only bound scores from above. Items are looked up in blocks, each in two
    passes over the index. Documents and items whose text is null or has no term match nothing; items without a match have no
    rows, and no more rows than documents of a score above 0. Repeated rows of documents rank each, repeated item_ids are
    answered each; other columns are ignored; empty tables give no rows. A text is held whole by one task.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), text.cast("binary").alias("text"))
    counts = base.select("text").mapInArrow(frugal(counted), "term binary, df long, total long")
    known = saved(counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")))
    numbered = cut(items.select("item_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.monotonically_increasing_id().alias("item")))
    result = numbered.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    stats = known.where(F.octet_length("term") == 0).first()
    if stats is None or not stats.df:
        return result
    corpus = Corpus(stats.df, stats.total)
    held = known.where(F.octet_length("term") > 0)
    least = (held.agg(F.sum("df")).first()[0] or 0) // frequent
    weights = spark.sparkContext.broadcast({bytes(r.term): corpus.weight(r.df) for r in held.where(F.col("df") > least).toLocalIterator()})
    index = saved(base.select("row", "text").mapInArrow(frugal(folded(corpus, weights, size)), "row long, places array<int>, impacts array<int>"))
    blocks = -(-numbered.count() // block_items)
    for number in range(blocks):
        rows = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        found = [(r.item, dict(Counter(terms(bytes(r.text))))) for r in rows]
        asked = spark.createDataFrame([(bytearray(t),) for t in sorted({t for _, x in found for t in x})], "term binary")
        weigh = {bytes(r.term): corpus.weight(r.df) for r in held.join(F.broadcast(asked), "term").collect()}
        block = Block(found, weigh, corpus, size)
        result = result.unionByName(answers(base, index, numbered, block, corpus, kind))
    return result


def answers(base: DataFrame, index: DataFrame, numbered: DataFrame, block: Block, corpus: Corpus, kind: str) -> DataFrame:
    """The best documents of a block of items."""
    every = F.lit(list(range(len(block.numbers)))).cast("array<int>")
    best = index.mapInArrow(frugal(highest(block, AHEAD)), "item long, row long, bound double")
    order = Window.partitionBy("item").orderBy(F.desc("bound"))
    ahead = cut(best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= AHEAD).select("row").distinct())
    texts = base.join(small(ahead, ahead.count(), 16), "row", "left_semi").select("doc_id", "text", every.alias("places"))
    scored = texts.mapInArrow(frugal(exact(block, corpus)), f"item long, doc_id {kind}, score long")
    thresholds = {r.item: r.score for r in ranked(scored).where(F.col("rank") == TOP).select("item", "score").collect()}
    reached = index.mapInArrow(frugal(reaching(block, thresholds, corpus.unit)), "row long, places array<int>")
    left = cut(reached.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places")))
    size = left.agg(F.sum(F.size("places") * 4 + 48)).first()[0] or 0
    texts = base.join(small(left, 1, size), "row").select("doc_id", "text", "places")
    scored = texts.mapInArrow(frugal(exact(block, corpus)), f"item long, doc_id {kind}, score long")
    final = cut(ranked(scored))
    return numbered.select("item_id", "item").join(final, "item").select("item_id", "rank", "doc_id", "score")
