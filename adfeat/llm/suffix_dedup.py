"""Repeated byte strings of a fixed length: suffixes are radix-sorted only through that depth, most significant digit first.

A window is the first `depth` bytes of a suffix. Its most significant digit is the `digit` bytes at its minimizer, the
place in it whose bytes have the least hash (leftmost at ties): equal windows have it at the same offset. Neighbouring
windows share that place, so the first pass orders one entry per place and not one per suffix.

Pass 1 groups the places by that digit; a group of one holds no repeated window. Pass 2 goes on through the full depth, for all
windows of a place at once: if a group knows but one context (the bytes of all windows of a place), or a context stands there
twice, these windows are repeated. Pass 3 orders by all their bytes the windows of places that alone have their context in
a group of several, next to one place of each other context; equal groups are exactly the repeated windows. As radix sorts do, it
finishes small groups in memory; only the windows of groups of very many contexts are shuffled one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import saved
from adfeat.llm.encoding import frugal

DEPTH, DIGIT = 200, 40  # bytes
PART = 1 << 18  # windows of a text looked at together; longer texts go part by part
HOT_KEYS = 100_000  # a key is hot if it holds more than one in so many rows: no more than so many keys are
GROUP = 1024  # contexts of a group that is finished in memory
WHOLE, GIVES, ASKS, LARGE = 1, 2, 4, 8  # marks: windows are repeated; take part in pass 3; are decided there; in a large group
RUN = 1_500_000  # bytes of contexts finished together


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Places:
    """Minimizers of all windows of a text."""

    BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64

    def __init__(self, depth: int = DEPTH, digit: int = DIGIT):
        self.depth, self.digit = depth, digit
        size = PART + depth
        self.up, self.down = _powers(self.BASE, size), _powers(pow(self.BASE, -1, 1 << 64), size)
        self.letters = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.low = np.uint64((1 << (size.bit_length())) - 1)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=sums[1:])
        h = (sums[self.digit :] - sums[: -self.digit]) * self.down[: len(data) - self.digit + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def _part(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, last window and digit of each place."""
        h, span = self._hashes(data), self.depth - self.digit + 1
        keys = (h & ~self.low) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(keys) // span) * span, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(data) - self.depth + 1
        least = (np.minimum(back[:n], ahead[span - 1 : span - 1 + n]) & self.low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        return first, np.append(first[1:] - 1, n - 1), h[least[first]].view(np.int64)

    def __call__(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """First window, last window, digit and context of each place."""
        view = memoryview(text)
        for at in range(0, len(text) - self.depth + 1, PART):
            first, last, digits = self._part(np.frombuffer(text, np.uint8)[at : at + PART + self.depth - 1])
            for a, b, d in zip((first + at).tolist(), (last + at).tolist(), digits.tolist()):
                made = hashlib.blake2b(view[a : b + self.depth], digest_size=8).digest()
                yield a, b, d, int.from_bytes(made, "little", signed=True)


def places(depth: int, digit: int) -> Callable:
    """Rows (row, digit, context) of all places."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Places(depth, digit)

        def made(rows, digits, contexts):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows, digits, contexts)], names=["row", "digit", "context"])

        for batch in batches:
            rows, digits, contexts = [], [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                for _, _, d, c in find(text.as_py()):
                    rows.append(row), digits.append(d), contexts.append(c)
                    if len(rows) == 100_000:
                        yield made(rows, digits, contexts)
                        rows, digits, contexts = [], [], []
            yield made(rows, digits, contexts)

    return task


def looked_up(rows: DataFrame, counts: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """rows that have their keys in counts (keys, n, more), with the other columns of counts.

    Hot keys, of which there are HOT_KEYS at most, are broadcast; their rows are dealt out by `spread`, so that no task gets
    all rows of a key. The rest is a join on the keys.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > total
    more = F.struct(*[c for c in counts.columns if c not in keys])
    few = counts.where(hot).select(*[F.col(k).alias(f"_h{k}") for k in keys], more.alias("_hot"))
    many = counts.where(~hot).select(*[F.col(k).alias(f"_c{k}") for k in keys], more.alias("_cold"), F.lit(0).cast("long").alias("_dealt"))
    left = rows.join(F.broadcast(few), [F.col(k) == F.col(f"_h{k}") for k in keys], "left")
    left = left.withColumn("_deal", F.when(F.col("_hot").isNull(), 0).otherwise(F.xxhash64(spread)))
    both = left.join(many, [*[F.col(k) == F.col(f"_c{k}") for k in keys], F.col("_deal") == F.col("_dealt")], "left")
    found = both.withColumn("_found", F.coalesce("_hot", "_cold")).where(F.col("_found").isNotNull())
    return found.select(*rows.columns, "_found.*")


def marks(base: DataFrame, depth: int, digit: int) -> DataFrame:
    """(row, found): per text its contexts that matter, with their marks."""
    rows = base.select("row", "text").mapInArrow(frugal(places(depth, digit)), "row long, digit long, context long")
    groups = rows.groupBy("digit").agg(F.count(F.lit(1)).alias("n"), (F.min("context") != F.max("context")).alias("several"))
    kept = saved(looked_up(rows, saved(groups.where("n > 1")), ["digit"], "row").select(*rows.columns, "several"))
    contexts = saved(kept.where("several").groupBy("digit", "context").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("giver")))
    # more than GROUP contexts: no more digits than places / GROUP, so these are not hinted but left to Spark
    large = contexts.groupBy("digit").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > GROUP).select("digit", F.lit(LARGE).alias("large"))
    contexts = contexts.join(large, "digit", "left").withColumn("large", F.coalesce("large", F.lit(0)))
    closed = kept.where(~F.col("several")).select("row", "context", F.lit(WHOLE).alias("mark"))
    mark = F.when(F.col("n") == 1, F.col("large") + GIVES + ASKS).when(F.col("row") == F.col("giver"), F.col("large") + WHOLE + GIVES).otherwise(WHOLE)
    opened = looked_up(kept.where("several"), saved(contexts), ["digit", "context"], "row").select("row", "context", mark.alias("mark"))
    return closed.unionByName(opened).groupBy("row").agg(F.collect_set(F.struct("context", "mark")).alias("found"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that touch or overlap joined."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def kept_digest(text: bytes, spans: list[tuple[int, int]]) -> str:
    made, at, view = hashlib.sha256(), 0, memoryview(text)
    for start, end in spans:
        made.update(view[at:start])
        at = end
    made.update(view[at:])
    return made.hexdigest()


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
OPEN = pa.list_(pa.struct([("digit", pa.int64()), ("at", pa.int64()), ("asks", pa.bool_()), ("bytes", pa.binary())]))
WINDOWS = pa.list_(pa.struct([("high", pa.int64()), ("low", pa.int64()), ("at", pa.int64())]))
_SPANS = "spans array<struct<start: bigint, end: bigint>>"
FIRST = f"""doc_id {{}}, row long, n_bytes long, {_SPANS}, kept_sha256 string,
    opened array<struct<digit: bigint, at: bigint, asks: boolean, bytes: binary>>, windows array<struct<high: bigint, low: bigint, at: bigint>>, packed binary"""
LAST = f"doc_id {{}}, n_bytes long, {_SPANS}, kept_sha256 string"


def _structs(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they are shuffled and stored, compressed one by one."""
    for batch in batches:
        made = [pa.compress(text.as_py(), codec="zstd", asbytes=True) for text in batch.column("text")]
        sizes = pa.array([len(text.as_py()) for text in batch.column("text")], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), sizes, pa.array(made, pa.binary())], names=["doc_id", "row", "n_bytes", "packed"])


def unpacked(batch: pa.RecordBatch, k: int) -> bytes:
    return pa.decompress(batch.column("packed")[k].as_py(), decompressed_size=batch.column("n_bytes")[k].as_py(), codec="zstd", asbytes=True)


def decided(depth: int, digit: int) -> Callable:
    """Per text the spans of pass 2 and what pass 3 needs of it: its open places with their bytes, or, of large groups, its
    windows (`at` -1: others are compared with it). Texts go on where something is to be decided."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Places(depth, digit)
        for batch in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            spans, digests, opened, windows, texts = [], [], [], [], []
            for k, (found, kept) in enumerate(zip(batch.column("found"), batch.column("packed"))):
                text, said = unpacked(batch, k), {x["context"]: x["mark"] for x in found.as_py() or []}
                whole, places, asked, asks = [], [], [], False
                for a, b, d, context in find(text) if said else ():
                    mark = said.get(context, 0)
                    asks |= bool(mark & ASKS)
                    if mark & WHOLE:
                        whole.append((a, b + depth))
                    if mark & GIVES and not mark & LARGE:
                        places.append({"digit": d, "at": a, "asks": bool(mark & ASKS), "bytes": text[a : b + depth]})
                    elif mark & GIVES:
                        for at in range(a, b + 1):
                            key = hashlib.blake2b(text[at : at + depth], digest_size=16).digest()
                            high, low = (int.from_bytes(x, "little", signed=True) for x in (key[:8], key[8:]))
                            asked.append({"high": high, "low": low, "at": at if mark & ASKS else -1})
                whole = merged(whole)
                spans.append(_structs(whole)), digests.append(kept_digest(text, whole))
                opened.append(places), windows.append(asked), texts.append(kept.as_py() if asks else None)
            made = [pa.array(spans, SPANS), pa.array(digests, pa.string()), pa.array(opened, OPEN), pa.array(windows, WINDOWS), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), batch.column("n_bytes"), *made],
                names=["doc_id", "row", "n_bytes", "spans", "kept_sha256", "opened", "windows", "packed"])

    return task


class Windows:
    """Which windows of some contexts are equal."""

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, depth: int):
        self.depth, self.powers = depth, []
        self.letters = np.random.default_rng(12).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)

    def repeated(self, contexts: list[bytes]) -> list[np.ndarray]:
        """Per context, for each of its windows whether it stands anywhere else among them. Windows are told apart by 128 bits."""
        data = np.frombuffer(b"".join(contexts), np.uint8)
        sizes = np.array([len(x) for x in contexts])
        starts = np.cumsum(sizes) - sizes
        n = sizes - self.depth + 1
        ends = np.cumsum(n)
        at = np.repeat(starts - (ends - n), n) + np.arange(ends[-1])
        if not self.powers or len(self.powers[0][0]) < len(data):
            self.powers = [(_powers(b, len(data)), _powers(pow(b, -1, 1 << 64), len(data))) for b in self.BASES]
        keys = np.empty((len(at), 2), np.uint64)
        for k, (up, down) in enumerate(self.powers):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.letters[k][data] * up[: len(data)], out=sums[1:])
            keys[:, k] = (sums[at + self.depth] - sums[at]) * down[at]
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        same = (keys[order[1:]] == keys[order[:-1]]).all(axis=1)
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        return np.split(twice, ends[:-1])


def finishing(depth: int) -> Callable:
    """Spans (row, start, end) of the windows that are repeated within their group; rows come ordered by digit."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare = Windows(depth)

        def found(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            for (row, _, at, asks, _), twice in zip(rows, compare.repeated([x[4] for x in rows]) if rows else ()):
                if asks and twice.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], twice, [False]]).astype(np.int8)))
                    out += [(row, at + a, at + b - 1 + depth) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
            made = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["row", "start", "end"])

        rows, size = [], 0
        for batch in batches:
            for x in zip(*(batch.column(c).to_pylist() for c in ("row", "digit", "at", "asks", "bytes"))):
                if size >= RUN and x[1] != rows[-1][1]:
                    yield found(rows)
                    rows, size = [], 0
                rows.append(x)
                size += len(x[4])
        yield found(rows)

    return task


def finished(depth: int) -> Callable:
    """Per text all spans: those of pass 2 and those that pass 3 found."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, digests = batch.column("spans").to_pylist(), batch.column("kept_sha256").to_pylist()
            for k, (more, hits) in enumerate(zip(batch.column("more"), batch.column("hits"))):
                if batch.column("packed")[k].is_valid and (more.is_valid or hits.is_valid):
                    hit = set(hits.as_py() or [])
                    new = [(x["start"], x["end"]) for x in more.as_py() or []]
                    new += [(x["at"], x["at"] + depth) for x in batch.column("windows")[k].as_py() if x["at"] >= 0 and x["low"] in hit]
                    whole = merged([(s["start"], s["end"]) for s in spans[k]] + new)
                    spans[k], digests[k] = _structs(whole), kept_digest(unpacked(batch, k), whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(spans, SPANS), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "spans", "kept_sha256"])

    return task


def repeats(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """doc_id, n_bytes, spans (start, end: maximal runs of bytes to remove) and kept_sha256 (digest of the remaining bytes).

    Texts are UTF-8 bytes. A byte is removed if a string of `depth` bytes covers it that starts anywhere else too, in the same
    text or another; overlaps count, all strings are judged on the input. Null texts count as empty, texts of fewer bytes keep all. Every
    row is judged, repeated rows remove each other; null doc_ids are kept; other columns are ignored; an empty table gives no
    rows. Texts go part by part; the list of what is repeated in a text is held by the task that has the text.

    Windows are told apart by 128 bits of hashes: 64 of the digit and 64 of the context, or 128 of all their bytes. Groups of up to
    GROUP contexts are finished by one task, larger ones window by window.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), text.cast("binary").alias("text"))
    found = marks(base.where(F.octet_length("text") >= depth), depth, digit)
    texts = base.mapInArrow(packed, f"doc_id {kind}, row long, n_bytes long, packed binary")
    first = saved(texts.join(found, "row", "left").mapInArrow(frugal(decided(depth, digit)), FIRST.format(kind)))
    opened = first.select("row", F.explode("opened").alias("o")).select("row", "o.*").repartition("digit").sortWithinPartitions("digit")
    spans = opened.mapInArrow(frugal(finishing(depth)), "row long, start long, end long")
    more = spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("more"))
    windows = first.select("row", F.explode("windows").alias("w")).select("row", "w.*")
    twice = windows.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hits = looked_up(windows.where("at >= 0"), saved(twice), ["high", "low"], "row").groupBy("row").agg(F.collect_set("low").alias("hits"))
    again = first.drop("opened").join(more, "row", "left").join(hits, "row", "left")
    return again.drop("row").mapInArrow(frugal(finished(depth)), LAST.format(kind))


def without(text: Column, spans: Column) -> Column:
    """The bytes of a text that are left when its spans are taken out."""
    data = text.cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(data).cast("long")))
    return F.aggregate(
        F.arrays_zip(starts.alias("a"), ends.alias("b")), F.lit(b"").cast("binary"),
        lambda out, s: F.concat(out, F.substring(data, (s["a"] + 1).cast("int"), (s["b"] - s["a"]).cast("int"))))
