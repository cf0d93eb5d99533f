"""Alignment of two tokenizers against whole texts encoded at once and cut by the bytes of their tokens."""

import collections
import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_alignment
from tidemark.llm.tokens import byte_signs

PATHS = token_alignment.default_paths()
SCHEMA = "doc_id long, text string, row string, id int, links string, n_a int, pair double"
SAMPLES = [
    None, "", " ", "  a  b ", "\n\n x\ty 　z", "foo bär 日本 \U0001d4b3 x", "don't <|endoftext|> <s></s> <0x41> <unk> ▁▁a ▁",
    "á ​‍ ﻿ \x00\x1c\x85 \xa0 b", "x" * 3000, "\U0001f600" * 50, "ab " * 500, "▁", "▁ x", "aaaaé" * 200, "1234 5678,90  -- ''s",
]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    signs = {c: i for i, c in enumerate(byte_signs())}
    return a, b, {i: bytes(signs[c] for c in t) for t, i in a.get_vocab().items() if all(c in signs for c in t)}


def plain(models, text):
    """Groups of ids of the whole text."""
    a, b, a_bytes = models
    want = f" {text}".encode()
    x, y = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text or "", return_type=int)
    x_raw = [a_bytes[i] for i in x]
    y_raw = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
    if not text or b"".join(x_raw) != want or b"".join(y_raw) != want:
        return []
    x_ends, y_ends = np.cumsum([len(t) for t in x_raw]), np.cumsum([len(t) for t in y_raw])
    cuts = np.intersect1d(x_ends, y_ends)
    groups = [([], []) for _ in cuts]
    for side, ids, ends in ((0, x, x_ends), (1, y, y_ends)):
        for i, group in zip(ids, np.searchsorted(cuts, ends)):
            groups[group][side].append(i)
    return groups


def as_text(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


@pytest.mark.parametrize("text", SAMPLES)
def test_samples(models, text):
    check(models, text)


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("ab  \n\t'é▁<s>|\xa0　\U0001f600"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(models, text):
    check(models, text)


ALIGNER = token_alignment.Aligner(*PATHS)


def check(models, text):
    want = plain(models, text)
    counts, groups, first, pairs, times = ALIGNER.align([None, text, ""])
    assert groups == ["", as_text(want), ""] and counts[[0, 2]].sum() == 0
    links = collections.Counter(x * ALIGNER.width + y for xs, ys in want for x in xs for y in ys)
    assert counts[1].tolist() == [sum(len(g[0]) for g in want), sum(len(g[1]) for g in want), len(want), sum(links.values())]
    assert dict(zip(pairs.tolist(), times.tolist())) == links and first.tolist() == [0, 0, len(links), len(links)]


@pytest.mark.parametrize("common", [1 << 18, 60, 0])
def test_scores(spark, models, monkeypatch, common):
    monkeypatch.setattr(token_alignment, "COMMON", common)
    monkeypatch.setattr(token_alignment, "BATCH_TEXT", 300)
    monkeypatch.setattr(token_alignment, "CACHED", 50)
    rng = random.Random(common)
    words = ["the", "of", "été", "tokenizer", "x1", "\U0001f600", "Hello,", "world.\nNew", "a", "b", "  "]
    rows = [(i, t) for i, t in enumerate(SAMPLES)] + [(None, "the of"), (3, "the of"), (3, "the of")]
    rows += [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(40)]
    texts = [plain(models, t) for _, t in rows]
    links = [collections.Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in texts]
    counts = collections.Counter(p for c in links for p in c)
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    want = [(i, len(g), sum(c.values()), sum(n for p, n in c.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in c.items()),
             as_text(g)) for (i, _), g, c in zip(rows, texts, links)]
    docs = spark.createDataFrame([(*r, "r", 1, "l", 2, 0.5) for r in rows], SCHEMA)
    got = token_alignment.aligned(token_alignment.written(token_alignment.token_groups(docs), "groups"), ALIGNER.width).collect()
    assert sorted(((r.id, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=repr) == sorted(want, key=repr)


def test_query(spark, models):
    got = token_alignment.op12_token_alignment(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = as_text(plain(models, d.text))
        assert rows[d.doc_id].groups_sha256 == (hashlib.sha256(want.encode()).hexdigest() if want else "")


def test_empty_table(spark):
    table = token_alignment.written(token_alignment.token_groups(spark.createDataFrame([], SCHEMA)), "groups")
    assert token_alignment.aligned(table, ALIGNER.width).collect() == []
