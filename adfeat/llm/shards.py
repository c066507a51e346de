"""Shards by a k-d tree over metadata, split at weighted medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import cut, numbered, small, text_key

BUCKETS, EXACT = 4096, 0.0002  # of a histogram pass; share of a node's bytes that may fall on the wrong side of a split
TOP = (1 << 31) - 1


def dimension(df: DataFrame, name: str) -> Column:
    """A metadata column as a number of 31 bits: integers as they are, within the range, everything else hashed."""
    if dict(df.dtypes)[name] in ("tinyint", "smallint", "int", "bigint"):
        value = F.greatest(F.lit(0), F.least(F.col(name).cast("long"), F.lit(TOP)))
    else:
        value = F.xxhash64(F.col(name)).bitwiseAND(F.lit(TOP))
    return F.coalesce(value, F.lit(0)).cast("long")


def split(rows: DataFrame, dims: list[str]) -> DataFrame:
    """One level of the tree: every node with more than one leaf is split along its widest dimension.

    The weighted median is found by histograms over all rows, narrowed until what is left on the border is EXACT of the
    node. Equal values are told apart by a hash of the row, so that a value of any weight can be split. The driver sees one
    row per node, which are as many as leaves at most.
    """
    spark = rows.sparkSession
    spans = rows.groupBy("node").agg(F.max("leaves").alias("leaves"), F.sum("size").alias("bytes"), *[F.struct(F.min(d), F.max(d)).alias(f"{d}_span") for d in dims]).collect()
    whole = {d: max(1, max(r[f"{d}_span"][1] for r in spans) - min(r[f"{d}_span"][0] for r in spans)) for d in dims}
    states = {}
    for r in spans:
        if r["leaves"] > 1:
            widest = max(range(len(dims)), key=lambda k: ((r[f"{dims[k]}_span"][1] - r[f"{dims[k]}_span"][0]) / whole[dims[k]], -k))
            low, high = r[f"{dims[widest]}_span"]
            states[r["node"]] = {"dim": widest, "low": low << 32, "high": (high << 32) | 0xFFFFFFFF, "need": r["bytes"] * (r["leaves"] // 2) / r["leaves"], "bytes": r["bytes"], "open": True}
    if not states:
        return rows
    key = F.shiftleft(F.get(F.array(*dims), F.col("dim")), 32).bitwiseOR(F.col("tie"))

    def joined(nodes: dict) -> DataFrame:
        made = spark.createDataFrame([(n, s["dim"], s["low"], s["high"]) for n, s in nodes.items()], "node long, dim int, low long, high long")
        return rows.join(small(made, len(nodes), 64), "node", "left").withColumn("key", key)

    while any(s["open"] for s in states.values()):
        todo = {n: s for n, s in states.items() if s["open"]}
        wide = F.floor((F.col("high") - F.col("low")) / BUCKETS).cast("long") + 1
        inside = joined(todo).filter("key between low and high").withColumn("wide", wide)
        histogram = inside.groupBy("node", F.expr("(key - low) div wide").alias("bucket"), "wide").agg(F.sum("size").alias("bytes"))
        seen: dict = {}
        for r in histogram.collect():  # at most BUCKETS rows per node
            seen.setdefault(r["node"], []).append((r["bucket"], r["bytes"], r["wide"]))
        for n, s in todo.items():
            for bucket, weight, width in sorted(seen.get(n, [])):
                if s["need"] <= weight:
                    s["low"], s["high"] = s["low"] + bucket * width, min(s["high"], s["low"] + (bucket + 1) * width - 1)
                    s["open"] = weight > max(1.0, EXACT * s["bytes"]) and s["low"] < s["high"]
                    if not s["open"] and s["need"] < weight / 2:
                        s["high"] = s["low"] - 1  # the border goes right
                    break
                s["need"] -= weight
            else:
                s["open"] = False
    sides = joined(states)
    right = F.col("high").isNotNull() & (F.col("key") > F.col("high"))
    node, leaves = F.col("node"), F.col("leaves")
    half = F.floor(leaves / 2).cast("int")
    parted = F.col("high").isNotNull()
    return cut(sides.select(
        *[c for c in rows.columns if c not in ("node", "leaves")],
        F.when(parted & right, node + half).otherwise(node).cast("long").alias("node"),
        F.when(parted, F.when(right, leaves - half).otherwise(half)).otherwise(leaves).cast("int").alias("leaves")))


def shard(docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: leaves of a k-d tree over `dims`, of nearly equal bytes.

    Give the number of shards, or the bytes that a shard should have. size is the text's UTF-8 bytes and 1; null texts have
    size 1 and the crc32 of nothing. Slots are gapless from 0 within a shard. Null metadata counts as 0, repeated rows are
    placed each (equal ones together), null doc_ids are kept; an empty table gives no rows; columns that are not `dims` are
    ignored. Rows of equal metadata are split only where a median falls on them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", text_key()).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"), *[dimension(docs, d).alias(f"dim_{k}") for k, d in enumerate(dims)])
    rows = cut(base)
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows = rows.withColumn("node", F.lit(0).cast("long")).withColumn("leaves", F.lit(shards))
    for _ in range((shards - 1).bit_length()):
        rows = split(rows, [f"dim_{k}" for k in range(len(dims))])
    placed = rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    return numbered(placed, "shard").withColumnRenamed("rank", "slot")
