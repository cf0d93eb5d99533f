"""Ranked search against scoring every document in plain Python."""

import collections
import math
import random
import re

import pytest

from tidemark.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, row string, n int, term string, tf int, id string, level int"
ITEMS = "item_id long, text string, row string, query int, rank string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    counts = [collections.Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in counts]
    size, total = sum(x > 0 for x in n), sum(n)
    out = []
    for item, text in items:
        scores = collections.Counter()
        for t in terms(text):
            df = sum(t in c for c in counts)
            for d, c in enumerate(counts):
                if t in c:
                    w = math.floor(1000 * math.log((2 * size + 2) / (2 * df + 1)))
                    scores[d] += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n[d] * size // total)))
        large = 1 << 62
        best = sorted((-s, large if docs[d][0] is None else docs[d][0]) for d, s in scores.items() if s > 0)[:k]
        out += [(item, r + 1, None if i == large else i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["é", "Été", "ÉTÉ", "naïve", "日本", "x_y", "a-b", "<b>"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(None, None), (None, "W1 w59"), (5, ""), (5, "w3 W3, w3"), (7, " \t-\n"), (8, "zz " * 5000 + "w40")]
    docs += [(rng.randint(0, 150), " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for _ in range(300)]
    docs += [(1000 + i, "the very same text w50 w51 w52") for i in range(30)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(25)]
    items += [(3, None), (4, ""), (None, "w2 w2 w50"), (100, "unheard of"), (101, "SAME very the w50 w51 w52"), (102, "w0"), (102, "w0")]
    return docs, items


@pytest.mark.parametrize("k,rarity", [(10, 4.0), (3, 1.5), (400, 4.0)])
def test_against_plain(spark, monkeypatch, k, rarity):
    monkeypatch.setattr(ranked_search, "RARITY", rarity)
    monkeypatch.setattr(ranked_search, "BATCH_TERMS", 50)
    docs, items = made(k)
    table = spark.createDataFrame([(*d, "r", 1, "t", 2, "i", 3) for d in docs], SCHEMA)
    asked = spark.createDataFrame([(*i, "r", 1, "x") for i in items], ITEMS)
    got = ranked_search.ranked_search(table, asked, k=k).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == plain(docs, items, k)


def test_nothing_to_find(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "w1", "r", 1, "t", 2, "i", 3)], SCHEMA)
    items, no_items = spark.createDataFrame([(1, "w1 w2", "r", 1, "x")], ITEMS), spark.createDataFrame([], ITEMS)
    other = spark.createDataFrame([(1, "w2", "r", 1, "x")], ITEMS)
    for docs, asked in ((none, items), (some, no_items), (none, no_items), (some, other)):
        got = ranked_search.ranked_search(docs, asked)
        assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranked_search, "SEGMENT", 7)
    text = "aa bb,cccccccccccccccc é日本x  A9" * 20
    assert ranked_search.terms_of(text.encode()) == collections.Counter(t.encode() for t in terms(text))
    assert ranked_search.terms_of(b"x" * 50 + b"  " + b"y") == {b"x" * 50: 1, b"y": 1}
