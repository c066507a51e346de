"""Queries that apply each operator to its whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.llm import (
    alignment, arrow_sequences, decontamination, lexical_search, licenses, neardup, packing, pii, quality, shards, suffix_dedup, token_counts, toxicity)
from adfeat.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_sequences.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard(table(spark, sf_dir, "documents"), ["source", "n_chars", "lang"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(pii.KINDS)],
                        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark, licenses.KNOWN))
    return found.withColumn("notices", F.array_join("notices", ","))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.scored(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_arrow_sequences": op1,
    "op2_decontamination": op2,
    "op3_weak_supervision": op3,
    "op4_best_fit_packing": op4,
    "op5_kd_tree_shards": op5,
    "op6_pii_bootstrap": op6,
    "op7_probminhash": op7,
    "op8_pu_toxicity": op8,
    "op9_token_counts": op9,
    "op10_license_digests": op10,
    "op11_suffix_radix_dedup": op11,
    "op12_max_sketch_search": op12,
    "op13_galloping_alignment": op13,
}


def text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("'", "''") + "'"


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), {decontamination.WINDOW}) AS n FROM items WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, d.n, i, item_id FROM doc_windows d JOIN item_windows b ON d.win = b.win AND d.n = b.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def _canonical(column: str) -> str:
    """SQL twin of licenses.canonical."""
    plain = f"regexp_replace(lower(coalesce({column}, '')), {text(licenses.COPYRIGHT)}, '', 'g')"
    plain = f"regexp_replace(regexp_replace({plain}, '&', ' and ', 'g'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')"
    out = f"' ' || trim({plain}) || ' '"
    for other, usual in licenses.EQUIVALENT:
        out = f"replace({out}, ' {other} ', ' {usual} ')"
    return f"trim({out})"


_LICENSES = f"""
WITH known AS (SELECT sha256({_canonical('t')}) AS digest, min(license) AS license
  FROM (VALUES {', '.join(f'({text(name)}, {text(body)})' for name, body in licenses.KNOWN)}) v(license, t) GROUP BY 1),
units AS (SELECT doc_id, text, unnest(list_distinct([coalesce(text, '')] || regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n') || string_split(coalesce(text, ''), chr(10)))) AS unit FROM documents),
found AS (SELECT doc_id, text, count(DISTINCT license) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM units JOIN known ON sha256({_canonical('unit')}) = digest GROUP BY doc_id, text),
whole AS (SELECT DISTINCT doc_id, text, {_canonical('text')} AS made FROM documents)
SELECT w.doc_id, CASE WHEN made <> '' THEN sha256(made) END AS text_digest, k.license, coalesce(f.notices, '') AS notices, CAST(coalesce(f.n, 0) AS BIGINT) AS n_notices
FROM whole w LEFT JOIN known k ON made <> '' AND sha256(made) = k.digest
LEFT JOIN found f ON w.doc_id IS NOT DISTINCT FROM f.doc_id AND w.text IS NOT DISTINCT FROM f.text
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents),
held AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM docs WHERE len(t) > 0),
tfs AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM docs WHERE len(t) > 0),
asked AS (SELECT item_id, i, term, count(*) AS times FROM (SELECT item_id, i, unnest(t) AS term FROM (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS t FROM benchmark)) GROUP BY ALL),
parts AS (SELECT item_id, i, r, doc_id, times * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))) AS s
  FROM asked JOIN dfs USING (term) JOIN tfs USING (term), corpus),
scores AS (SELECT item_id, i, r, doc_id, CAST(sum(s) AS BIGINT) AS score FROM parts GROUP BY ALL HAVING sum(s) > 0),
ranks AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scores)
SELECT * FROM ranks WHERE rank <= {lexical_search.TOP}
"""

ORACLES: dict[str, str] = {"op2_decontamination": _DECONTAMINATION, "op10_license_digests": _LICENSES, "op12_max_sketch_search": _SEARCH}
