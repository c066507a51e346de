"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import UPPER, few, saved, small, text_key
from adfeat.llm.encoding import frugal, raw

BITS, PREFIX = 18, 5  # hashed features, characters of a word's beginning that are a feature too
POSITIVES, UNLABELLED = 6_000, 18_000  # the training sample has about so many different texts at most
FEATURES, STEPS, RATE, DECAY = 2_000, 200, 0.1, 1e-4
THRESHOLD = 0.7

_CLEAN = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else ord(chr(c).lower()) if chr(c) in UPPER else 32 for c in range(256))


class Hasher:
    """Hashed features of a text: each of its words once, and how the words begin."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, int]] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        known, found = self.known, set()
        if len(known) > 150_000:
            known.clear()
        for word in set(text.translate(_CLEAN).split()):
            pair = known.get(word)
            if pair is None:
                start = word.decode("utf-8", "replace")[:PREFIX].encode()
                pair = zlib.crc32(word) & ((1 << BITS) - 1), zlib.crc32(b"^" + start) & ((1 << BITS) - 1)
                if len(word) <= 64:
                    known[word] = pair
            found.update(pair)
        return np.fromiter(found, np.int64, len(found))


def remainder() -> Column:
    """crc32 of the doc_id as text, modulo 3; rows of remainder 1 are held out. Null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3


def sums(weights: np.ndarray, at: np.ndarray, ids: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(at, weights[ids], minlength=rows)


def chosen_features(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The FEATURES most frequent among positives beyond their share in unlabelled text; counts: (unlabelled, positive) x features."""
    u, p = counts / np.maximum(rows, 1)[:, None]
    lift = (p - u) / np.sqrt(np.maximum(u, 1 / max(rows[0], 1)))
    chosen = np.argsort(-lift, kind="stable")[:FEATURES]
    return chosen[lift[chosen] > 0]


def risk(w: np.ndarray, b: float, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> float:
    """prior * E_pos[l(+)] + max(0, E_unl[l(-)] - prior * E_pos[l(-)]) with logistic losses: what training lowers."""
    z_p, z_u = (np.array([w[r].sum() + b for r in rows]) for rows in (positive, unlabelled))
    lose = lambda z: np.logaddexp(0, z).mean()
    return prior * lose(-z_p) + max(0.0, lose(z_u) - prior * lose(z_p))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, n: int) -> tuple[np.ndarray, float]:
    """Weights of n features and bias of a logistic classifier under the non-negative risk; rows are lists of features."""
    if not positive or not unlabelled:
        return np.zeros(n), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))

    def packed(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(k) for k in rows]), np.concatenate([*rows, np.empty(0, np.int64)])

    (pa_, pi), (ua, ui) = packed(positive), packed(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for step in range(1, STEPS + 1):
        gp, gu = sigmoid(sums(w, pa_, pi, n_p) + b), sigmoid(sums(w, ua, ui, n_u) + b)
        negative = np.mean(-np.log(1 - gu + 1e-12)) - prior * np.mean(-np.log(1 - gp + 1e-12))
        cp, cu = prior * (gp - 1) / n_p, np.zeros(n_u)  # of the positive part
        if negative >= 0:
            cp, cu = cp - prior * gp / n_p, gu / n_u
        else:  # the part that must not be negative is pushed back
            cp, cu = prior * gp / n_p, -gu / n_u
        grad = np.append(np.bincount(pi, cp[pa_], minlength=n) + np.bincount(ui, cu[ua], minlength=n) + DECAY * w, cp.sum() + cu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def features(docs: DataFrame) -> DataFrame:
    """(positive, features) of the rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            found = pa.array([hasher(t) for t in raw(batch.column("text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), found], names=["positive", "features"])

    return docs.select("positive", "text").mapInArrow(frugal(task), "positive boolean, features array<int>")


def narrowed(rows: DataFrame, chosen: np.ndarray) -> DataFrame:
    """The rows with the places of the chosen features alone, as 16-bit numbers: no row is larger than the choice."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, "<i2")
        place[chosen] = np.arange(len(chosen))
        for batch in batches:
            kept = [place[x.values.to_numpy()] for x in batch.column("features")]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array([k[k >= 0].tobytes() for k in kept], pa.binary())], names=["positive", "places"])

    return rows.mapInArrow(task, "positive boolean, places binary")


def sampled(rows: DataFrame, bound: int, n: int) -> DataFrame:
    """About 0.9 * `bound` different (doc_id, text) of n rows, or all of few rows: chosen by a hash of both, each once, so that
    neither an id nor a text of very many rows fills the sample or is missing from it as a whole."""
    share = min(1.0, 0.9 * bound / max(1, n))
    keyed = rows.select("doc_id", "text", text_key().alias("text_key"))
    some = keyed.filter(F.pmod(F.xxhash64(F.lit(8), F.col("doc_id"), F.col("text_key")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    return some.groupBy("doc_id", "text_key").agg(F.first("text").alias("text")).select("text")


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[np.ndarray, float]:
    """The classifier, from rows that are not held out. It learns from at most about `positives` confirmed toxic texts and `unlabelled`
    others, chosen by a hash of id and text; the class prior is the toxic share of all labels used.

    Spark counts the features of the sample per side; the driver gets the 2^BITS counts, and of each text the places of the
    FEATURES chosen ones: 2 bytes each."""
    learn = remainder() != 1
    known = labels.filter(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("toxic")).first()
    prior = min(0.9, max(0.001, counts["toxic"] / max(1, counts["n"])))
    usable = docs.filter(learn).select("doc_id", "text")
    # more ids than texts are wanted would only be dropped again
    share = int(min(1.0, positives / max(1, counts["toxic"])) * 1_000_000)
    ids = known.filter((F.col("toxic") == 1) & (F.pmod(F.xxhash64(F.lit(9), F.col("doc_id")), F.lit(1_000_000)) < share)).select("doc_id")
    sizes = ids.agg(F.count("*"), F.sum(F.octet_length(F.col("doc_id").cast("string")))).first()
    confirmed = usable.join(small(ids, 1, 16 * sizes[0] + (sizes[1] or 0)), "doc_id", "left_semi")
    texts = sampled(confirmed, positives, confirmed.count()).withColumn("positive", F.lit(True))
    others = sampled(usable, unlabelled, usable.count()).withColumn("positive", F.lit(False))
    rows = saved(few(features(texts.unionByName(others))))
    found, n_rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for r in rows.groupBy("positive").count().collect():
        n_rows[int(r["positive"])] = r["count"]
    held = rows.select(F.col("positive").cast("int").alias("side"), F.explode("features").alias("feature")).groupBy("side", "feature").count().toArrow()
    found[held.column("side").to_numpy(), held.column("feature").to_numpy()] = held.column("count").to_numpy()
    chosen = chosen_features(found, n_rows)
    small_rows = narrowed(rows, chosen).toArrow()
    made: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for side, places in zip(small_rows.column("positive").to_pylist(), small_rows.column("places").to_pylist()):
        made[side].append(np.frombuffer(places, "<i2").astype(np.int64))
    weights = np.zeros(1 << BITS)
    weights[chosen], bias = train(made[True], made[False], prior, len(chosen))
    return weights, bias


def scorer(weights: np.ndarray, bias: float) -> Callable[[], Callable[[pa.Array], np.ndarray]]:
    """What a task calls once to get its function from texts to scores; only weights that aren't 0 travel."""
    used = np.flatnonzero(weights)
    values = weights[used]

    def start() -> Callable[[pa.Array], np.ndarray]:
        hasher, dense = Hasher(), np.zeros(1 << BITS)
        dense[used] = values
        logit = lambda texts: [dense[hasher(t)].sum() + bias for t in raw(texts)]
        return lambda texts: 1 / (1 + np.exp(-np.clip(np.array([z for at in range(0, len(texts), 256) for z in logit(texts.slice(at, 256))], float), -50, 50)))

    return start


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.7) of each document.

    Learns a numpy classifier from confirmed toxic texts and unlabelled ones by the non-negative positive-unlabelled risk;
    labels of 0 only serve the class prior. Scores look at the text alone. Null and empty texts get the score of a text
    without features; repeated rows are scored each; null doc_ids are kept and learned from as the id ""; without any toxic
    label, or without documents, scores are the class prior; other columns are ignored.
    """
    scores = scorer(*fit(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scores()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(of(batch.column("text")))], names=["doc_id", "held_out", "score"])

    scored = docs.select("doc_id", (remainder() == 1).alias("held_out"), "text").mapInArrow(frugal(task), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, whose score is below 0.7."""
    scores = scorer(*fit(docs, labels))

    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # names of any kind pass through

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = scores()
        for batch in batches:
            yield batch.filter(pa.array(of(batch.column(at)) < THRESHOLD))

    return plain.mapInArrow(frugal(task), plain.schema).toDF(*docs.columns)
