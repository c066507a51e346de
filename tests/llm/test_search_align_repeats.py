"""Repeated byte strings, ranked search and alignment of tokenizers against brute force and on odd input."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adfeat.llm import alignment, lexical_search, suffix_dedup
from adfeat.llm.queries import QUERIES, vocabulary

SCHEMA = "doc_id long, text string, row long, digit string, spans string, found string, item string, term string, rank int, pairs string, links string"
BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SF = "/root/testdata/sf0.001"
TALE = "".join(f"In house {k} lives a cat of {k * k % 17} years, she sleeps. " for k in range(40))
ODD = [
    None, "", " \n\t ", "one", "one", "a" * 500, "a" * 199, "a" * 200, TALE, TALE[:700] + "!" + TALE[700:], TALE[31:231], TALE[40:239],
    "x" + TALE[300:499] + "y", "x" + TALE[300:500] + "y" + TALE[300:500], "É́ ​z　k œuvre <|endoftext|> " * 30, "中文字符" * 90,
    " ".join(str(k * 7919 % 1000) for k in range(5000)) + TALE[100:420]]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, *["clash"] * 5, 2, "clash", "clash") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_rows():
    return [*enumerate(ODD), (3, "one"), (8, TALE), (None, "no id " * 40), (None, None)]


def removed(texts, depth):
    seen = Counter(t[p : p + depth] for t in texts for p in range(len(t) - depth + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - depth + 1):
            if seen[t[p : p + depth]] > 1:
                gone[p : p + depth] = [True] * depth
        edges = [k for k in range(len(t) + 1) if (k > 0 and gone[k - 1]) != (k < len(t) and gone[k])]
        out.append((len(t), tuple(zip(edges[::2], edges[1::2])), hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize(("depth", "digit"), [(200, 40), (50, 8), (9, 9)])
def test_repeats_are_those_of_all_windows(spark, odd_rows, depth, digit):
    got = suffix_dedup.repeats(table(spark, odd_rows), depth, digit).collect()
    want = removed([(t or "").encode() for _, t in odd_rows], depth)
    assert sorted(((r.doc_id or -1, r.n_bytes, tuple(map(tuple, r.spans)), r.kept_sha256) for r in got), key=repr) == sorted(
        ((i or -1, *w) for (i, _), w in zip(odd_rows, want)), key=repr)


def test_repeats_in_texts_of_several_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcd", np.uint8)
    texts = [letters[rng.integers(0, 4, n)].tobytes().decode() for n in (900, 2500, 40)]
    texts += [texts[1][300:1900] + texts[0][:333], "".join(texts)]
    monkeypatch.setattr(suffix_dedup, "PART", 64)
    find = suffix_dedup.Places(30, 6)
    for text in texts:
        windows = [p for a, b, _, _ in find(text.encode()) for p in range(a, b + 1)]
        assert windows == list(range(len(text) - 29))
    monkeypatch.undo()
    got = suffix_dedup.repeats(table(spark, enumerate(texts)), 30, 6).collect()
    want = removed([t.encode() for t in texts], 30)
    assert {r.doc_id: (r.n_bytes, tuple(map(tuple, r.spans)), r.kept_sha256) for r in got} == dict(enumerate(want))


def test_hot_keys_and_large_groups_go_like_others(spark, odd_rows, monkeypatch):
    want = sorted(map(repr, suffix_dedup.repeats(table(spark, odd_rows)).collect()))
    for keys, group, run in ((0, 0, 1), (3, 2, 700)):
        monkeypatch.setattr(suffix_dedup, "HOT_KEYS", keys)
        monkeypatch.setattr(suffix_dedup, "GROUP", group)
        monkeypatch.setattr(suffix_dedup, "RUN", run)
        assert sorted(map(repr, suffix_dedup.repeats(table(spark, odd_rows)).collect())) == want


def test_texts_without_their_repeats(spark, odd_rows):
    docs = table(spark, [(i, t) for i, t in odd_rows if i is not None and i != 3 and i != 8])
    left = docs.select("doc_id", "text").join(suffix_dedup.repeats(docs), "doc_id")
    got = left.select("kept_sha256", F.sha2(suffix_dedup.without(F.coalesce("text", F.lit("")), F.col("spans")), 256).alias("made")).collect()
    assert got and all(r.kept_sha256 == r.made for r in got)


def best_documents(docs, items):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            if c:
                m = 25 + (75 * c.total() * n_docs) // n_terms
                scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c), i))
        ranks = sorted((-s, i is None, i or 0) for s, i in scores if s > 0)[:10]
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(ranks, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("size", "block", "frequent"), [(4096, 256, 200_000), (1, 2, 3), (64, 3, 20)])
def test_search_ranks_like_scoring_everything(spark, odd_rows, size, block, frequent):
    docs = [*odd_rows, *[(100 + k, f"cat number {k % 5} sleeps in house {k}") for k in range(60)], (None, "cat")]
    items = [(1, "The cat sleeps, a CAT!"), (2, None), (3, "nothing-known zzz"), (4, "house 17 years one"), (4, "œuvre 7919"), (None, "in a of")]
    asked = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, item int")
    got = lexical_search.search(table(spark, docs), asked, size, block, frequent).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == best_documents(docs, items)


def test_search_in_nothing(spark):
    none, some = table(spark, []), spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert lexical_search.search(none, some).collect() == []
    assert lexical_search.search(table(spark, [(1, None), (2, " ")]), some).collect() == []
    assert lexical_search.search(table(spark, [(1, "cat")]), some.limit(0)).collect() == []


def aligned(texts):
    one, two = alignment.ByteLevelEncoder(vocabulary(BYTE)), alignment.PieceEncoder(vocabulary(PIECE))
    rows = []
    for text in texts:
        data = b" " + (text or "").encode()
        a = one.tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.model.encode(text or "")
        if not text or b"".join(one.bytes[x] for x in a) != data or b"".join(two.bytes[x] for x in b) != data:
            rows.append(([], [], []))
            continue
        ends = [np.cumsum([len(e.bytes[x]) for x in ids]).tolist() for e, ids in ((one, a), (two, b))]
        both, groups, i, j = set(ends[0]) & set(ends[1]), [], 0, 0
        for end in sorted(both):
            ga, gb = [], []
            while i < len(a) and ends[0][i] <= end:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends[1][j] <= end:
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
        rows.append((a, b, groups))
    counts = Counter(pair for _, _, groups in rows for pair in {(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, groups in rows:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def test_alignment_is_that_of_set_intersection(spark, odd_rows, monkeypatch):
    more = [(200 + k, t) for k, t in enumerate(["\nfirst line", " \n", "!x\n\ny", "7 up, a.b", "a▁b", " two  spaces ", "ﬁ ﬀ ½", "\x00\x01 ctrl\r\n", "😀👍🏽 emoji", "it's <s> </s> <unk> <0x41>"])]
    rows = [*odd_rows, *more]
    want = sorted(((i or -1, *w) for (i, _), w in zip(rows, aligned([t for _, t in rows]))), key=repr)
    for keys, pairs in ((200_000, 4_000_000), (0, 7), (5, 100)):
        monkeypatch.setattr(alignment, "HOT_KEYS", keys)
        monkeypatch.setattr(alignment, "PAIRS", pairs)
        got = alignment.scored(table(spark, rows), vocabulary(BYTE), vocabulary(PIECE)).collect()
        assert sorted(((r.doc_id or -1, *tuple(r)[1:]) for r in got), key=repr) == want


def test_galloping_finds_the_first_value_not_less():
    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (5, 40), (300, 310), (7, 5000)):
        long = np.unique(rng.integers(0, 10_000, m))
        short = np.unique(rng.integers(0, 10_000, n))
        short = short[short <= long[-1]]
        start = rng.integers(0, len(long), len(short))
        assert (alignment.gallop(short, long, start) == np.searchsorted(long, short)).all()


def test_groups_of_many_links_are_counted_by_id(monkeypatch):
    a, b = np.array([1, 1, 2, 5, 6]), np.array([3, 3, 4, 9])
    arguments = (a, b, np.array([0, 3, 5]), np.array([0, 3, 4]), np.array([0, 1]))
    keys, links = alignment.linked(*arguments)
    monkeypatch.setattr(alignment, "PAIRS", 2)
    again = alignment.linked(*arguments)
    assert keys.tolist() == again[0].tolist() and links.tolist() == again[1].tolist() == [4, 2, 2, 1, 1, 1]


@pytest.mark.parametrize("name", ["op11_suffix_radix_dedup", "op13_galloping_alignment"])
def test_queries_on_the_smallest_tables(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES[name](spark, SF).collect()
    if name.startswith("op11"):
        want = {d.doc_id: (n, sum(b - a for a, b in spans), len(spans), digest)
                for d, (n, spans, digest) in zip(docs, removed([d.text.encode() for d in docs], 200))}
    else:
        want = {d.doc_id: w for d, w in zip(docs, aligned([d.text for d in docs]))}
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_empty_tables(spark):
    none = table(spark, [])
    assert suffix_dedup.repeats(none).collect() == []
    assert alignment.scored(none, vocabulary(BYTE), vocabulary(PIECE)).collect() == []
