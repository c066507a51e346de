"""Token ids in Arrow IPC files of equal-length sequences and masks, read by memory map without a copy."""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from adfeat.llm.common import shared_dir, text_key
from adfeat.llm.encoding import WordEncoder, frugal

LENGTH, ROWS, END = 2048, 256, 1  # ids of a sequence, sequences of a record batch, id that ends a document
MANIFEST = "part int, ids_file string, index_file string, n_documents long, n_tokens long"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path; a bare path is local."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def sequence_schema(length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length))])


def batch_of(ids: np.ndarray, length: int) -> pa.RecordBatch:
    """Sequences of the ids; the last is padded with 0 and masked there."""
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, "<u2")
    padded[: len(ids)] = ids
    real = np.zeros(rows * length, bool)
    real[: len(ids)] = True
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (padded, real)]
    return pa.RecordBatch.from_arrays(columns, schema=sequence_schema(length))


def write(docs: DataFrame, folder: str, tokenizer: str, length: int = LENGTH, rows: int = ROWS, end: int = END) -> list:
    """Encode each whole text, end it with `end` and write all ids in ascending doc_id order; returns the manifest.

    Each task of a range partitioning by doc_id writes an ids file (sequences of `length` ids, `rows` to a record batch, and a
    mask that is false on the padding of the file's last sequence) and an index file (doc_id, start in the file, n_tokens).
    Only batches of a file are in memory. Names are unique to an attempt, so a repeated task disturbs nothing; files that no
    manifest row names are left-overs of lost attempts. The manifest has a row per task, in order, and is all that the driver
    gets. Null texts count as empty; null doc_ids come first; rows of equal doc_id follow each other, repeated rows each; an
    empty table gives an empty manifest; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, name = WordEncoder(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex
        ending, out, index, pending, local, documents = np.array([end], "<u2").tobytes(), None, None, bytearray(), 0, 0
        uris = [f"{folder}/{part:06d}-{name}.{kind}.arrow" for kind in ("ids", "index")]
        streams: list = []
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    for uri in uris:
                        system, path = opened(uri)
                        streams.append(system.open_output_stream(path))
                    out = pa.ipc.new_file(streams[0], sequence_schema(length))
                    index = pa.ipc.new_file(streams[1], index_schema(batch))
                sizes = []
                for ids in encoder.encode(batch.column("text")):
                    sizes.append(len(ids) // 2 + 1)
                    pending += ids + ending
                    while len(pending) >= 2 * rows * length:
                        out.write_batch(batch_of(np.frombuffer(bytes(pending[: 2 * rows * length]), "<u2"), length))
                        del pending[: 2 * rows * length]
                counts = np.array(sizes, np.int64)
                starts = local + np.cumsum(counts) - counts
                index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(counts)], schema=index_schema(batch)))
                local, documents = local + int(counts.sum()), documents + len(counts)
            if out is not None:
                if pending:
                    out.write_batch(batch_of(np.frombuffer(bytes(pending), "<u2"), length))
                out.close()
                index.close()
        finally:
            for stream in streams:
                stream.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "ids_file": uris[:1], "index_file": uris[1:], "n_documents": [documents], "n_tokens": [local]})

    ordered = docs.select("doc_id", "text", text_key().alias("text_key")).repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    return sorted(ordered.select("doc_id", "text").mapInArrow(frugal(task), MANIFEST).collect())


def index_schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema([("doc_id", batch.schema.field("doc_id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])


def reader(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A local file is memory-mapped: batches are views of it."""
    system, path = opened(uri)
    source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
    return pa.ipc.open_file(source)


def sequence(file: pa.ipc.RecordBatchFileReader, row: int, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Ids (a view, not a copy) and mask of one sequence, wherever it stands in the file."""
    batch, at = file.get_batch(row // rows), row % rows
    ids, mask = batch.column("ids"), batch.column("mask")
    length = ids.type.list_size
    return (ids.values.slice(ids.offset * length + at * length, length).to_numpy(zero_copy_only=True),
            mask.values.slice(mask.offset * length + at * length, length).to_numpy(zero_copy_only=False))


def real_ids(file: pa.ipc.RecordBatchFileReader) -> Iterator[np.ndarray]:
    """The ids of a file without padding, batch by batch."""
    for k in range(file.num_record_batches):
        batch = file.get_batch(k)
        ids, mask = batch.column("ids").flatten(), batch.column("mask").flatten()
        yield ids.to_numpy(zero_copy_only=True)[: mask.true_count]


def read(spark, manifest: list, like: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start among all ids, n_tokens and ids_crc32 (of the ids as 32-bit little-endian)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stream, chunk = real_ids(reader(row["ids_file"])), np.empty(0, "<u2")
                index = reader(row["index_file"])
                for k in range(index.num_record_batches):
                    docs = index.get_batch(k)
                    sums = []
                    for n in docs.column("n_tokens").to_pylist():
                        crc = 0
                        while n:
                            if not len(chunk):
                                chunk = next(stream)
                            took, chunk = chunk[:n], chunk[n:]
                            crc, n = zlib.crc32(took.astype("<u4").tobytes(), crc), n - len(took)
                        sums.append(crc)
                    starts = np.asarray(docs.column("start")) + row["first"]
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(starts, pa.int64()), docs.column("n_tokens"), pa.array(sums, pa.int64())],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])

    first, files = 0, []
    for row in manifest:
        files.append((row["part"], row["ids_file"], row["index_file"], first))
        first += row["n_tokens"]
    kind = like.schema["doc_id"].dataType.simpleString()
    listed = spark.createDataFrame(files, "part int, ids_file string, index_file string, first long")
    return listed.repartition(max(1, len(files)), "part").mapInArrow(task, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Write the files below the shared folder and read them back."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/sequences-{uuid.uuid4().hex}"
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return read(spark, write(docs, folder, tokenizer, length), docs)
