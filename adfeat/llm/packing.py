"""Best-fit packing of documents into sequences, in bulk-synchronous sweeps."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import numbered
from adfeat.llm.encoding import ByteEncoder, frugal

LENGTH, END = 1024, 2  # ids of a sequence, id that ends a document


def sweep(sizes: dict[int, int], length: int) -> list[tuple[int, int, int, int]]:
    """(size, first rank, first sequence, offset): where the pieces of each size go, from that rank on.

    Pieces and gaps are range-sorted by size. Each sweep takes the largest pieces left and matches them, as many as there are,
    with their successor: the smallest gap that holds them. Ranks settle who gets which gap: the i-th piece gets the i-th
    gap. The gaps shrink and the next sweep begins; pieces without a gap open sequences. Gaps are runs of sequences with
    equal gaps, so a sweep is a step over runs; there are at most `length` sizes and gaps, whatever the number of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, count)
    gaps: list[int] = []
    plan, opened = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                insort(gaps, gap)
            runs.setdefault(gap, []).append((first, count))

    for size in sorted(sizes, reverse=True):
        left, rank = sizes[size], 0
        while left:
            at = bisect_left(gaps, size)
            if at == len(gaps):  # no gap holds this size: open as many sequences as the rest needs
                need = -(-left // (length // size))
                put(length, opened, need)
                opened += need
                continue
            gap = gaps[at]
            first, count = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], gaps[at]
            took = min(left, count)
            plan.append((size, rank, first, length - gap))
            put(gap, first + took, count - took)
            put(gap - size, first, took)
            left, rank = left - took, rank + took
    return plan


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Ranked pieces: doc_id, piece, start, length and ids (32-bit little-endian) of the pieces of each document, `end` included.

    Only documents of more than `length` ids are cut; all pieces but the first then have `length` ids.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer)
        ending = np.array([end], "<u2").tobytes()
        for batch in batches:
            encoded = encoder.encode(batch.column("text"))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[tuple] = []
                for k, found in enumerate(islice(encoded, part.num_rows)):
                    ids = np.frombuffer(found + ending, "<u2").astype("<u4")
                    first = (len(ids) - 1) % length + 1
                    edges = [0, *range(first, len(ids) + 1, length)]
                    rows += [(k, n, a, b - a, ids[a:b].tobytes()) for n, (a, b) in enumerate(zip(edges, edges[1:]))]
                doc, n, start, size, ids = zip(*rows)
                columns = [part.column("doc_id").take(pa.array(doc)), pa.array(n, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    return numbered(docs.select("doc_id", "text"), "length", frugal(task), f"doc_id {kind}, piece int, start long, length long, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """The pieces with sequence_id and offset: best-fit decreasing, few sequences, no gaps between the pieces of one.

    Pieces get a rank within their size without a shuffle of ids; the sweeps work on the counts by size (at most `length`
    rows) and say which ranks go where. Null texts count as empty (one id); null doc_ids are kept; repeated rows are packed
    each; an empty table gives no rows; other columns are ignored. Which of two pieces of equal size goes where is open.
    """
    ranked = pieces(docs, tokenizer, length, end)
    plan = sweep({r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}, length)
    by_size: dict[int, np.ndarray] = {}
    for size, *row in plan:
        by_size.setdefault(size, []).append(row)
    by_size = {size: np.array(rows, np.int64) for size, rows in by_size.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(size), 2), np.int64)
        sizes, ranks = size.to_numpy(), rank.to_numpy()
        for s in np.unique(sizes):
            rows, mine = by_size[int(s)], sizes == s
            found = rows[np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1]
            out[mine, 0] = found[:, 1] + ranks[mine] - found[:, 0]
            out[mine, 1] = found[:, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids", "place.sequence_id", "place.offset")
