"""Token counts of whole texts; huge ones in overlapping chunks that are spliced where both sides agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adfeat.llm.common import cut, on_doc, text_key
from adfeat.llm.encoding import WordEncoder, frugal, load

CHUNK, OVERLAP, AGREE = 16_384, 512, 4  # characters of a chunk, of them shared with the next; tokens that must agree on both sides of a splice
LIMIT = 2048

SUMMARY = "doc_id {}, text_key long, chunk int, n long, head binary, tail binary"


def chunks(chunk: int, overlap: int):
    """Rows (doc_id, text_key, chunk, first, last, before, text): pieces of a text that share `overlap` characters with the next."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text in zip(batch.column("doc_id"), batch.column("text_key"), batch.column("text")):
                whole, rows, at = text.as_py(), [], 0
                while True:
                    end = min(len(whole), at + chunk)
                    rows.append((len(rows), at, end == len(whole), whole[at - 1] if at else " ", whole[at:end]))
                    if end == len(whole):
                        break
                    at = end - overlap
                number, first, last, before, pieces = zip(*rows)
                ids = pa.array([doc_id.as_py()] * len(rows), batch.schema.field("doc_id").type)
                columns = [ids, pa.array([key.as_py()] * len(rows), pa.int64()), pa.array(number, pa.int32()), pa.array(first, pa.int64()), pa.array(last), pa.array(before), pa.array(pieces)]
                table = pa.Table.from_arrays(columns, names=["doc_id", "text_key", "chunk", "first", "last", "before", "text"])
                yield from table.to_batches(max_chunksize=64)

    return task


def summaries(tokenizer: str, overlap: int):
    """Per chunk: its token count and, as (start, end, id, after a space) in the whole text, the tokens in what it shares with its neighbours."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load(tokenizer)
        for batch in (whole.slice(at, 32) for whole in batches for at in range(0, whole.num_rows, 32)):
            rows = batch.to_pydict()
            heads, tails, counts = [], [], []
            for first, last, before, text, found in zip(rows["first"], rows["last"], rows["before"], rows["text"], library.encode_batch(rows["text"], add_special_tokens=False)):
                spans = np.array(found.offsets, np.int64).reshape(-1, 2)
                spaced = np.array([(text[s - 1] if s else before).isspace() for s in spans[:, 0]], np.int64)
                tokens = np.column_stack([spans + first, np.array(found.ids, np.int64), spaced]) if len(spans) else np.empty((0, 4), np.int64)
                counts.append(len(tokens))
                heads.append(tokens[spans[:, 0] < overlap].tobytes() if first else b"")
                tails.append(b"" if last else tokens[spans[:, 0] >= len(text) - overlap].tobytes())
            columns = [batch.column("doc_id"), batch.column("text_key"), batch.column("chunk"), pa.array(counts, pa.int64()), pa.array(heads, pa.binary()), pa.array(tails, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "chunk", "n", "head", "tail"])

    return task


def splice(tail: bytes, head: bytes) -> int | None:
    """Tokens to take off both chunks together, or None where no stable boundary is found.

    A boundary is stable if the same token starts there after a space in both encodings and the AGREE tokens on either side
    are the same too, place and id.
    """
    a, b = (np.frombuffer(x, np.int64).reshape(-1, 4) for x in (tail, head))
    where = {tuple(t): j for j, t in enumerate(b.tolist())}
    best = None
    for i, token in enumerate(a.tolist()):
        j = where.get(tuple(token))
        if j is None or not token[3] or min(i, j, len(a) - i - 1, len(b) - j - 1) < AGREE:
            continue
        if (a[i - AGREE : i + AGREE + 1] == b[j - AGREE : j + AGREE + 1]).all():
            margin = min(i, len(b) - j)  # farthest from where either chunk was cut
            if best is None or margin > best[0]:
                best = (margin, len(a) - i + j)
    return None if best is None else best[1]


def spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk, the tokens it adds once what the next one repeats is taken off; `apart` if they could not be spliced."""
    for batch in batches:
        off = [0 if following is None else splice(tail, following) for tail, following in zip(batch.column("tail").to_pylist(), batch.column("following").to_pylist())]
        n = [count - (x or 0) for count, x in zip(batch.column("n").to_pylist(), off)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array([x is None for x in off])], names=["doc_id", "text_key", "n", "apart"])


def count_long(long: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, text_key, n_tokens) of texts in chunks; those that don't splice are tried again with wider overlaps and chunks."""
    kind = long.schema["doc_id"].dataType.simpleString()
    done, todo = None, long
    while True:
        rows = todo.mapInArrow(chunks(chunk, overlap), f"doc_id {kind}, text_key long, chunk int, first long, last boolean, before string, text string")
        # One row per chunk, dealt out over all tasks, so that a huge text is no one task's work.
        dealt = rows.repartition("doc_id", "text_key", "chunk")
        made = dealt.mapInArrow(frugal(summaries(tokenizer, overlap)), SUMMARY.format(kind)).dropDuplicates(["doc_id", "text_key", "chunk"])
        order = Window.partitionBy("doc_id", "text_key").orderBy("chunk")
        paired = made.select("doc_id", "text_key", "n", "tail", F.lead("head").over(order).alias("following"))
        parts = paired.mapInArrow(spliced, f"doc_id {kind}, text_key long, n long, apart boolean")
        counted = cut(parts.groupBy("doc_id", "text_key").agg(F.sum("n").alias("n_tokens"), F.max("apart").alias("apart")))
        whole = counted.filter(~F.col("apart")).drop("apart")
        done = whole if done is None else done.unionByName(whole)
        failed = counted.filter("apart").select("doc_id", "text_key")
        if failed.isEmpty():
            return done
        todo = on_doc(todo, failed, "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap


def count(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each whole text, as the library gives them.

    Texts of up to `chunk` characters are encoded where they are read. Longer ones are cut into chunks that overlap, the
    chunks are dealt out over all tasks, and neighbours are spliced at a boundary that both encodings agree on; where none is
    found, chunk and overlap grow fourfold, in the end to the whole text. Null texts count as empty (0 bytes, 0 tokens);
    repeated rows are counted each; null doc_ids are kept; an empty table gives no rows; other columns are ignored.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer)
        for batch in batches:
            n = pa.array([len(ids) // 2 for ids in encoder.encode(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])

    sized = F.octet_length("text").cast("long").alias("n_bytes")
    here = base.filter(F.length("text") <= chunk).select("doc_id", sized, "text").mapInArrow(frugal(short), f"doc_id {kind}, n_bytes long, n_tokens long")
    long = base.filter(F.length("text") > chunk).withColumn("text_key", text_key())
    counted = count_long(long, tokenizer, chunk, overlap)
    there = on_doc(long.select("doc_id", "text_key", sized), counted, "inner").select("doc_id", "n_bytes", "n_tokens")
    return here.unionByName(there).withColumn("over_limit", F.col("n_tokens") > limit)
