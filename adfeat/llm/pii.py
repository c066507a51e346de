"""Personal data by fixed shapes and by bootstrapped lexical patterns, native."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfeat.llm.common import cut, few, let, on_doc, saved, small, text_key, upto, whole_row

KINDS = ["email", "ip", "card", "phone"]
#: kind: what a text must hold for a match, and the shape; possessive, so that long runs take linear time without recursion.
SHAPES: dict[str, tuple[str, str]] = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){13}", r"(?=[0-9](?:[\x20-]?[0-9]){13})[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Unseen identifiers: runs of six or more such characters with a digit.
TOKEN = r"(?<![A-Za-z0-9._%+@/-])(?=[A-Za-z0-9._%+@/-]{6})[A-Za-z._%+@/-]*+[0-9][A-Za-z0-9._%+@/-]*+"
#: The same in groups of digits: two or more, each maybe in parentheses, joined by nothing but those, one space or one hyphen.
GROUP = r"(?:\([0-9]++\)|[0-9]++(?![._]?[A-Za-z0-9_%+@/]))"
GROUPS = rf"(?<![A-Za-z0-9._%+@/-])\+?{GROUP}(?:[\x20-]?{GROUP})++"
ROUNDS, SUPPORT, SURE = 3, 3, 0.6  # scoring rounds, distinct seeds behind a pattern, least score of patterns and instances
SPAN = "array<struct<start:int,kind:int,end:int,instance:string,patterns:array<string>>>"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(number)

    def step(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(back, i + 1, F.lit(1))) - 48
        doubled = digit * (1 + i % 2)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(upto(F.length(number)), F.lit(0), step) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    n = F.length(digits(match))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return n.between(14, 19) & luhn(digits(match))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def context(before: Column, after: Column) -> Column:
    """Lexical patterns of a place: the two words before it, and the words on either side, in lower case."""
    left = F.filter(F.split(F.lower(F.right(before, F.lit(80))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    right = F.filter(F.split(F.lower(F.left(after, F.lit(40))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def made(words: Column) -> Column:
        n = F.size(words)
        two = F.when(n >= 2, F.concat(F.get(words, n - 2), F.lit(" "), F.get(words, n - 1), F.lit(" _")))
        sides = F.when((n >= 1) & (F.size(right) >= 1), F.concat(F.get(words, n - 1), F.lit(" _ "), F.get(right, F.lit(0))))
        return F.array_compact(F.array(two, sides))

    return let(left, made)


def matches(text: Column, needs: str, shape: str, kind: int) -> Column:
    """Leftmost matches that don't overlap, with places in code points and their patterns."""

    def located(found: Column, between: Column) -> Column:
        start = lambda acc, i: acc["at"] + F.length(F.get(between, i))
        step = lambda acc, i: F.struct(
            (start(acc, i) + F.length(F.get(found, i))).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                start(acc, i).alias("start"), F.lit(kind).alias("kind"), (start(acc, i) + F.length(F.get(found, i))).alias("end"),
                F.get(found, i).alias("instance"), context(F.get(between, i), F.get(between, i + 1)).alias("patterns")))).alias("out"))
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(upto(F.size(found)), zero, step, lambda acc: acc["out"])

    every = let(F.regexp_extract_all(text, F.lit(shape), F.lit(0)), lambda found: let(F.split(text, shape), lambda between: located(found, between)))
    return F.when(text.rlike(needs), every).otherwise(F.array().cast(SPAN))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base (personal data by shape) and tokens (other runs with a digit, and groups of digits: these may
    overlap or be equal), each as spans with patterns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text_key().alias("text_key"), text.alias("text"))

    def valid(kind: str, n: int) -> Column:
        return F.filter(matches(F.col("text"), *SHAPES[kind], n), lambda s: holds(kind, s["instance"]))

    kinds = [valid(kind, n) for n, kind in enumerate(KINDS)]
    grouped = F.filter(matches(F.col("text"), r"[0-9][\x20()-]++[0-9]", GROUPS, -1), lambda s: F.length(s["instance"]) >= 6)
    tokens = F.concat(matches(F.col("text"), "[0-9]", TOKEN, -1), grouped)
    found = base.select("doc_id", "text_key", F.sort_array(F.concat(*kinds)).alias("base"), tokens.alias("tokens"))
    apart = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    return saved(few(found.withColumn("tokens", F.filter("tokens", apart))))


def patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, sure: float = SURE) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind, score) and instances (instance, kind, score), from the graph of both.

    Seeds are the base matches, sure of their kind. A pattern's score for a kind is what its instances' scores sum to, over
    their number and 1; an unknown instance's score is that of its best pattern. Both are computed in turn over all
    documents; only patterns with `support` distinct seeds count. Instances accepted after the scoring rounds are seeds
    from then on, with their scores, so that further patterns reach the support; this is repeated until no instance is
    added, however long the chain.
    """
    sides = [found.select(F.explode(c).alias("s")).select("s.instance", "s.kind", F.explode("s.patterns").alias("pattern")) for c in ("base", "tokens")]
    edges = cut(few(reduce(DataFrame.unionByName, sides).distinct()))
    shape = F.count("*").alias("seeds"), F.count("*").cast("double").alias("mass")
    base = cut(few(edges.filter("kind >= 0").groupBy("pattern", "kind").agg(*shape)))
    accepted, known = edges.sparkSession.createDataFrame([], "instance string, kind int, score double"), 0
    while True:
        # Only patterns that enough seeds induce can count by now: the rest of the graph waits for further seeds.
        learners = edges.filter("kind < 0").select("instance", "pattern").join(small(accepted, known, 128), "instance")
        gained = learners.groupBy("pattern", "kind").agg(F.count("*").alias("seeds"), F.lit(0.0).alias("mass"))
        able = base.unionByName(gained).groupBy("pattern", "kind").agg(F.sum("seeds").alias("seeds"), F.sum("mass").alias("mass"))
        able = cut(few(able.filter(F.col("seeds") >= support)))
        rows = able.count()
        near = cut(few(edges.join(small(able.select("pattern").distinct(), rows, 128), "pattern", "left_semi")))
        able = cut(able.join(near.groupBy("pattern").agg(F.countDistinct("instance").alias("n")), "pattern"), rows)
        unknown = near.filter("kind < 0").select("instance", "pattern")

        def scored(learned: DataFrame, able: DataFrame = able, unknown: DataFrame = unknown) -> DataFrame:
            more = unknown.join(learned, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("more"))
            return cut(able.join(more, ["pattern", "kind"], "left").select(
                "pattern", "kind", ((F.col("mass") + F.coalesce("more", F.lit(0.0))) / (F.col("n") + 1)).alias("score")), rows)

        scores, learned = scored(accepted), accepted
        for _ in range(rounds if rows else 0):
            met = unknown.join(small(scores, rows, 128), "pattern").select("instance", "kind", "score")
            learned = cut(few(met.unionByName(accepted).groupBy("instance", "kind").agg(F.max("score").alias("score"))))
            scores = scored(learned)
        accepted = learned.filter(F.col("score") >= sure)
        before, known = known, accepted.count()
        if known == before:
            return scores.filter(F.col("score") >= sure), accepted


def discovered(found: DataFrame, instances: DataFrame) -> DataFrame:
    """(doc_id, text_key, more): spans of accepted instances, wherever they stand; the surest kind of each."""
    best = instances.groupBy("instance").agg(F.min_by("kind", F.struct(-F.col("score"), "kind")).alias("kind"))
    best = cut(few(best))
    spots = found.select("doc_id", "text_key", F.explode("tokens").alias("t")).select("doc_id", "text_key", "t.instance", "t.start", "t.end")
    met = spots.join(small(best, best.count(), 128), "instance")
    return met.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and spans (both sorted arrays of start, kind, end) of each row.

    Base spans have fixed shapes. Their contexts induce lexical patterns; patterns and other identifier-like runs score each
    other over the whole corpus, and runs that sure patterns lead to become spans of that kind wherever they occur, and
    induce patterns in turn. Places are code points, ends exclusive; kind is an index of KINDS. Null and empty texts have no spans; repeated rows are given
    each; null doc_ids are kept; an empty table gives no rows; other columns are ignored.
    """
    found = occurrences(docs)
    more = discovered(found, patterns(found)[1])
    plain = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    joined = on_doc(found, more).select("doc_id", "text_key", plain(F.col("base")).alias("base"), "more")
    both = F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return joined.select("doc_id", "text_key", "base", F.sort_array(both).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced by the first one's kind."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.when(fresh, F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(spans, zero, step, done)


def redact(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data in `text` replaced; rows without any keep their text, null included."""
    spans = find(docs).filter(F.size("spans") > 0).select("doc_id", "text_key", F.col("spans").alias("__spans")).dropDuplicates(["doc_id", "text_key"])
    keyed = docs.select("doc_id", text_key().alias("text_key"), whole_row(docs).alias("row"))
    text = F.when(F.col("__spans").isNotNull(), redacted(F.col("row.text"), F.col("__spans"))).otherwise(F.col("row.text"))
    return on_doc(keyed, spans).select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
