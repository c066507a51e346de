"""Tokens of one vocabulary aligned with those of another: token ends are intersected by galloping, what lies between common
ends is a group, and rank differences give the tokens of both sides in it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import saved
from adfeat.llm.encoding import ByteEncoder, frugal, raw, steps

HOT_KEYS = 200_000  # a pair is hot if it holds more than one in so many rows: no more than so many pairs are
PAIRS = 1_000_000  # links made at a time
RUN = 1_500_000  # bytes of texts aligned together
SHIFT = 15  # bits of an id of the second vocabulary in a pair

ALIGNED = "doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups binary, pairs array<int>, links array<bigint>"


class PieceEncoder:
    """Ids by a sentencepiece model, and the bytes of each piece."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        found = self.model.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes


def byte_letters() -> dict[str, int]:
    """What byte each letter of a byte-level vocabulary stands for: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevelEncoder(ByteEncoder):
    """Byte-level ids of a space and the text, with strings of special tokens as plain text, and the bytes of each token."""

    ODD = ByteEncoder.ODD + r"|^\n"  # the space would stand next to other white space

    def pieces(self, texts: pa.Array) -> pa.ListArray:
        """As for a text, whose first piece here has a space before it like the others."""
        lines = pc.replace_substring(texts, "\n", f" {self.BARE}\n")
        return pc.split_pattern(pc.replace_substring_regex(lines, self.STOP, rf"\1 {self.BARE}\2"), " ")

    def unusual(self, text: str) -> bytes:
        return super().unusual(" " + text)

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(len(self.lengths))]
        self.bytes = [bytes(letters.get(c, 0) for c in token) for token in tokens]


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value of the shorter list the first place in the longer whose value isn't less; all at once.

    From `start` the steps double, to the right or left, until the value is passed; then the last step is halved. Both
    lists ascend and the last value of `long` is at least that of `short`.
    """
    last = len(long) - 1
    right = long[start] < short
    low, high = np.where(right, start, -1), np.where(right, last, start)  # long[low] < value <= long[high], -1: before all
    for way in (1, -1):
        todo, step = np.flatnonzero(right if way > 0 else ~right), 1
        while len(todo):
            probe = start[todo] + way * step
            inside = (probe >= 0) & (probe <= last)
            todo, probe = todo[inside], probe[inside]
            less = long[probe] < short[todo]
            low[todo[less]], high[todo[~less]] = probe[less], probe[~less]
            todo, step = todo[less if way > 0 else ~less], 2 * step
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        less = long[middle] < short[todo]
        low[todo[less]], high[todo[~less]] = middle[less], middle[~less]
        todo = todo[high[todo] - low[todo] > 1]
    return high


def common(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the values that both ascending lists hold; of_a, of_b: where the tokens of each text begin, and the end."""
    if len(b) < len(a):
        j, i = common(b, a, of_b, of_a)
        return i, j
    texts = np.repeat(np.arange(len(of_a) - 1), np.diff(of_a))
    n_a, n_b = np.diff(of_a)[texts], np.diff(of_b)[texts]
    start = of_b[texts] + (np.arange(len(a)) - of_a[texts]) * n_b // n_a  # as far into its text as the value is into its own
    places = gallop(a, b, start)
    same = b[places] == a
    return np.flatnonzero(same), places[same]


def expand(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each count n, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def linked(a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text << 32 | pair, links) of all groups, each key once; group g holds a[from_a[g]:from_a[g+1]] and the same of b.

    Groups of many links are first counted by id on both sides, so that what is held follows the different pairs."""
    n_a, n_b = np.diff(from_a), np.diff(from_b)
    keys, links = [], []

    def add(found: np.ndarray, weights: np.ndarray) -> None:
        different, where = np.unique(found, return_inverse=True)
        keys.append(different), links.append(np.bincount(where, weights, len(different)).astype(np.int64))

    usual = np.flatnonzero(n_a * n_b <= PAIRS)
    runs = np.cumsum(n_a[usual] * n_b[usual]) // PAIRS
    for run in np.split(usual, np.flatnonzero(np.diff(runs)) + 1) if len(usual) else []:
        wide = n_b[run]
        left = np.repeat(from_a[run], n_a[run]) + expand(n_a[run])  # each token of a
        width = np.repeat(wide, n_a[run])
        right = np.repeat(np.repeat(from_b[run], n_a[run]), width) + expand(width)
        found = (np.repeat(np.repeat(text[run], n_a[run]), width) << 32) | (np.repeat(a[left], width) << SHIFT) | b[right]
        add(found, np.ones(len(found)))
    for g in np.flatnonzero(n_a * n_b > PAIRS):
        ids_a, times_a = np.unique(a[from_a[g] : from_a[g + 1]], return_counts=True)
        ids_b, times_b = np.unique(b[from_b[g] : from_b[g + 1]], return_counts=True)
        rows = max(1, PAIRS // len(ids_b))
        for at in range(0, len(ids_a), rows):
            some = slice(at, at + rows)
            add((text[g] << 32) | (ids_a[some, None] << SHIFT | ids_b).ravel(), (times_a[some, None] * times_b).ravel())
    if len(keys) == 1:
        return keys[0], links[0]
    every, weight = np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate([*links, np.empty(0, np.int64)])
    different, where = np.unique(every, return_inverse=True)
    totals = np.zeros(len(different), np.int64)
    np.add.at(totals, where, weight)
    return different, totals


def edges_of(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def given_back(tokens: pa.Array, ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether the bytes of the tokens of each text, joined, are its bytes."""
    joined = tokens.take(pa.array(ids))
    at = np.frombuffer(joined.buffers()[1], np.int32)[edges_of(sizes)].astype(np.int64)
    made = np.frombuffer(joined.buffers()[2], np.uint8) if len(ids) else np.empty(0, np.uint8)
    good = np.diff(at) == np.diff(edges)
    for k in np.flatnonzero(good).tolist():
        good[k] = np.array_equal(made[at[k] : at[k + 1]], data[edges[k] : edges[k + 1]])
    return good


def aligner(first: str, second: str) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = ByteLevelEncoder(first), PieceEncoder(second)
        size_a, size_b = (np.array([len(x) for x in e.bytes], np.int64) for e in (one, two))
        tokens_a, tokens_b = (pa.array(e.bytes, pa.binary()) for e in (one, two))
        # an id as it is written, with what follows it inside its side (0) or at its end (1); the longest has five digits
        written = np.array([[f"{i}{c}".encode() for c in pair] for pair, n in ((",|", len(size_a)), (",;", len(size_b))) for i in range(n)], "S8")

        def aligned(texts: pa.Array) -> list[pa.Array]:
            plain = texts.cast(pa.string()).fill_null("")
            n, spaced = len(texts), [b" " + x for x in raw(plain)]
            data, edges = np.frombuffer(b"".join(spaced), np.uint8), edges_of(np.fromiter(map(len, spaced), np.int64, n))
            found = list(one.encode(plain))
            all_a, sizes_a = np.frombuffer(b"".join(found), "<u2"), np.fromiter(map(len, found), np.int64, n) // 2
            all_b, sizes_b = two.encode(plain.to_pylist())
            whole = given_back(tokens_a, all_a, sizes_a, data, edges) & given_back(tokens_b, all_b, sizes_b, data, edges) & (np.diff(edges) > 1)
            good = np.flatnonzero(whole)
            n_a, n_b, n_groups, n_links = np.zeros((4, n), np.int64)
            groups, edges, pairs, links = [b""] * n, np.zeros(n + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            if len(good):
                n_a[good], n_b[good] = sizes_a[good], sizes_b[good]
                a, b = (ids[np.repeat(whole, sizes)].astype(np.int64) for ids, sizes in ((all_a, sizes_a), (all_b, sizes_b)))
                of_a, of_b = edges_of(n_a[good]), edges_of(n_b[good])
                i, j = common(np.cumsum(size_a[a]), np.cumsum(size_b[b]), of_a, of_b)
                from_a, from_b = np.concatenate([[0], i + 1]), np.concatenate([[0], j + 1])
                last = np.searchsorted(i, of_a[1:] - 1)  # the group that ends each text
                n_groups[good] = np.diff(last, prepend=-1)
                text = np.repeat(good, n_groups[good])
                per_group = np.diff(from_a) * np.diff(from_b)
                np.add.at(n_links, text, per_group)
                keys, links = linked(a, b, from_a, from_b, text)
                pairs = keys & 0xFFFFFFFF
                edges = np.searchsorted(keys, np.arange(n + 1) << 32)
                # both sides of each group behind each other
                order = np.empty((len(a) + len(b), 2), np.int64)
                group_a, group_b = (np.repeat(np.arange(len(i)), np.diff(x)) for x in (from_a, from_b))
                end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                end_a[i], end_b[j] = 1, 1
                order[np.arange(len(a)) + from_b[group_a]] = np.column_stack([a, end_a])
                order[np.arange(len(b)) + from_a[group_b + 1]] = np.column_stack([b + len(size_a), end_b])
                for k, start, end in zip(good, of_a[:-1] + of_b[:-1], of_a[1:] + of_b[1:]):
                    groups[k] = written[order[start:end, 0], order[start:end, 1]].tobytes().replace(b"\0", b"")[:-1]
            offsets = pa.array(edges, pa.int32())
            return [
                *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)], pa.array(groups, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(links, pa.int64())),
            ]

        for batch in batches:
            at = 0
            for run in steps(batch.column("text"), RUN):
                made = aligned(run)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(run)), *made], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"])
                at += len(run)

    return task


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, its groups as text and its different id pairs with their links.

    `first` is a byte-level vocabulary, given a space and the text, `second` a sentencepiece model that adds the space itself.
    A pair is the first id, shifted by SHIFT bits, and the second."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return base.mapInArrow(frugal(aligner(first, second)), ALIGNED.format(kind))


def statistics(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many rows hold a pair, and whether no pair of the same first id is held by more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts.withColumn("first", F.shiftright("pair", SHIFT)))
    most = counts.groupBy("first").agg(F.max("n").alias("most"))
    return saved(counts.join(most, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def scored(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document (see align and statistics).

    Counts of pairs are taken over all documents. The most frequent pairs, HOT_KEYS at most, are looked up in a broadcast table
    where the rows are; only the others are shuffled. Null and empty texts, and texts that either vocabulary does not give
    back byte by byte, have no tokens: zeros and ''. Repeated rows count each; null doc_ids are kept; other columns are ignored; an
    empty table gives no rows. A very long text is aligned by one task, in arrays of its tokens.
    """
    groups = F.when(F.octet_length("groups") == 0, "").otherwise(F.sha2("groups", 256))
    rows = align(docs, first, second).withColumn("groups_sha256", groups).drop("groups")
    aligned = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    counts = statistics(aligned)
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_KEYS > total
    held = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", F.col("p.pairs").alias("pair"), "p.links")
    sums = [F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")]
    few = F.broadcast(counts.where(hot))
    near = held.join(few, "pair").groupBy("row").agg(*sums)
    far = held.join(few.select("pair"), "pair", "left_anti").join(counts.where(~hot), "pair").groupBy("row").agg(*sums)
    added = near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return aligned.drop("pairs", "links").join(added, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
