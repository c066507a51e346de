"""Quality rules combined by weak supervision, native."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import cut, let, space_words, upto

#: Each rule votes bad (-1) from the first bound on, good (1) up to the second, and abstains (0) in between.
RULES: dict[str, tuple[str, float, float]] = {
    "symbols": ("n_symbols / n_words", 0.10, 0.02),
    "capitals": ("n_upper / word_chars", 0.50, 0.05),
    "exclamations": ("n_exclaim / n_words", 0.20, 0.05),
    "repeated_lines": ("n_dup_lines / n_lines", 0.30, 0.05),
    "repeated_words": ("n_repeat_words / n_words", 0.25, 0.08),
    "long_words": ("word_chars / n_words", 7.0, 6.0),
    "unended_lines": ("1 - n_ended / n_lines", 0.30, 0.02),
}
#: EM steps; then what is believed beforehand, with the weight of so many texts, however many there are: the share of good
#: texts, and how often a rule votes good, abstains and votes bad on good (1) and on bad (-1) ones.
ROUNDS, PRIOR_TEXTS, PRIOR_GOOD = 100, 20, 0.8
PRIOR_VOTES = {1: {1: 0.75, 0: 0.2, -1: 0.05}, -1: {1: 0.5, 0: 0.2, -1: 0.3}}


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Window hashes are sorted with their place in the low bits; neighbours that share the high bits are compared in full.
    """

    def places(h: Column) -> Column:
        bits = F.ceil(F.log2(F.size(h) + F.lit(2))).cast("int")
        packed = F.sort_array(F.transform(h, lambda x, i: F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits).bitwiseOR(i.cast("long"))))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        at = lambda v: v.bitwiseAND(mask).cast("int")
        equal = lambda s, i, j: F.coalesce(F.get(h, at(F.get(s, i))) == F.get(h, at(F.get(s, j))), F.lit(False))
        twice = lambda s: F.transform(F.filter(upto(F.size(s)), lambda i: equal(s, i, i - 1) | equal(s, i, i + 1)), lambda i: at(F.get(s, i)))
        return let(packed, twice)

    hashes = F.transform(upto(F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    repeated = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.array().cast("array<int>")).otherwise(places(h))
    spread = lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2))))
    return let(let(hashes, repeated), spread)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each text that the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    of_words = let(space_words(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeats")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"), F.size(F.filter(
        x, lambda y: F.rtrim(y).rlike(r"[.!?:;,\"'…。)]$"))).alias("ended")))
    made = docs.select("doc_id", text.alias("text"), of_words.alias("w"), of_lines.alias("l"))
    return made.select(
        "doc_id", F.col("w.n").cast("long").alias("n_words"), F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), (F.col("l.n") - F.col("l.distinct")).cast("long").alias("n_dup_lines"),
        F.col("w.repeats").cast("long").alias("n_repeat_words"), F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclaim"), F.col("l.n").cast("long").alias("n_lines"),
        F.col("l.ended").cast("long").alias("n_ended"))


def vote(rule: str) -> Column:
    """1 good, -1 bad, 0 abstains; a text without words gets no votes."""
    share, bad, good = RULES[rule]
    top, _, below = share.removeprefix("1 - ").partition(" / ")
    value = F.try_divide(F.col(top), F.col(below))
    value = 1 - value if share.startswith("1 - ") else value
    return F.when(value >= bad, -1).when(value <= good, 1).otherwise(0)


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, list[dict[int, float]]]:
    """Prior log-odds of good and, per rule, the log-odds each vote adds, by expectation-maximisation over vote patterns.

    The rates at which a rule votes good, abstains and votes bad are estimated for good and for bad texts, so an abstention says as much
    as it turns out to. There are at most 3^rules patterns, whatever the number of texts.
    """
    n_rules, good = len(RULES), PRIOR_GOOD
    rates = [PRIOR_VOTES] * n_rules
    for _ in range(ROUNDS):
        adds = [_adds(t) for t in rates]
        seen = [{y: {v: PRIOR_TEXTS * PRIOR_VOTES[y][v] for v in (1, 0, -1)} for y in (1, -1)} for _ in range(n_rules)]
        total = {1: PRIOR_TEXTS * PRIOR_GOOD, -1: PRIOR_TEXTS * (1 - PRIOR_GOOD)}
        for votes, count in patterns:
            odds = math.log(good / (1 - good)) + sum(adds[r][v] for r, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for y, share in ((1, p), (-1, 1 - p)):
                total[y] += count * share
                for r, v in enumerate(votes):
                    seen[r][y][v] += count * share
        good = total[1] / (total[1] + total[-1])
        rates = [{y: {v: n / sum(found[y].values()) for v, n in found[y].items()} for y in (1, -1)} for found in seen]
    return math.log(good / (1 - good)), [_adds(t) for t in rates]


def _adds(rates: dict[int, dict[int, float]]) -> dict[int, float]:
    return {v: math.log(rates[1][v] / rates[-1][v]) for v in (1, 0, -1)}


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, posterior probability of good quality and the verdict kept.

    Rules vote or abstain; expectation-maximisation over the counts of vote patterns estimates how they vote on good and on bad texts;
    the posterior replaces an all-must-pass filter: a bad vote of a rule that often errs is outvoted. base_failed (fewer than 50
    words, or more than half of them in repeated 3-word windows) always rejects, and such texts are not learned from. A posterior of
    exactly 0.5 is kept. Null and empty texts count as 0 words, get no votes and fail the base; repeated rows are judged each;
    null doc_ids are kept; an empty table gives no rows; other columns are ignored; a text is held whole by one task.
    """
    voted = cut(measures(docs).select("*", *[vote(r).alias(f"vote_{r}") for r in RULES]).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    votes = [f"vote_{r}" for r in RULES]
    patterns = sorted((tuple(r[v] for v in votes), r["count"]) for r in voted.filter(~F.col("base_failed")).groupBy(*votes).count().collect())
    prior, adds = fit(patterns)
    odds = F.lit(prior)
    for name, add in zip(votes, adds):
        odds = odds + F.when(F.col(name) == 1, F.lit(add[1])).when(F.col(name) == -1, F.lit(add[-1])).otherwise(F.lit(add[0]))
    judged = voted.withColumn("quality", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
