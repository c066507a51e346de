"""A training corpus in five stages: toxicity, near duplicates, benchmark decontamination, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.llm import decontamination, neardup, packing, pii, toxicity
from adfeat.llm.common import few, rows_without, saved, table
from adfeat.llm.queries import vocabulary

# Of all stages: null texts count as empty, null ids are kept, columns of any names pass through, an empty table stays
# empty, and a text is held whole by the task that reads it. Each writes its table in few files.


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; a score of exactly the threshold rejects. Empty texts get the score of a
    text without features, repeated rows the same one."""
    return few(toxicity.accepted(docs, table(spark, sf_dir, "labels")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one of the least id, one of its rows if they repeat. Empty texts
    are copies of each other; texts of the same words at a similarity of exactly 0.8 are linked."""
    return few(neardup.deduplicated(docs))


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold so much benchmark text that they count as contaminated: a word in twenty or more. Empty texts stay,
    repeated rows stay or go together."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return few(rows_without(docs, found.filter("contaminated")))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, in repeated rows alike; n_chars follows where there is such a column. Null texts stay null."""
    made = few(pii.redact(docs))
    return made.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else made


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all documents in sequences of 1024; an empty text is its end id alone, repeated rows are packed each."""
    return few(packing.pack(docs, vocabulary("byte_bpe_50k.json")))


STAGES = [("toxicity", clean), ("near_duplicates", unique), ("decontamination", untested), ("pii", private), ("packing", packed)]
ORACLE_SQL = None  # the first stage is a trained classifier; tests/llm compares the operators with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other; each reads the Parquet table that the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
