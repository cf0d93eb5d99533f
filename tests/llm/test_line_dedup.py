"""Repeated lines against a plain version, with awkward rows and keys on both sides of the hot border."""

import random
import re

import pytest

from tidemark.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, row string, keep int, word double, n_lines string"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))


def plain(rows):
    """Rows with the texts that stay, counts of lines and of dropped lines."""
    large = 1 << 62
    first = {}
    for i, text in rows:
        for key in map(key_of, (text or "").split("\n")):
            if len(key) >= line_dedup.LEAST:
                first[key] = min(first.get(key, large), large if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = large if i is None else i
        kept = [x for x in lines if len(key_of(x)) < line_dedup.LEAST or first[key_of(x)] == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    pool = ["common line of all documents", "Exactly10!", "ninechars", "", "  ", "É" * 12, "é" * 12, "İstanbul İstanbul", "a\r"]
    pool += [f"line number {i} of the pool" for i in range(40)]
    rows = [(None, None), (3, ""), (3, None), (None, "common line of all documents\nonly without an id"), (1, "\n\n"),
            (900, "\n".join(["common line of all documents"] * 500 + [f"own line {i} here" for i in range(300)] * 2))]
    for i in range(120):
        lines = rng.choices(pool, k=rng.randint(0, 200 if i % 40 == 0 else 8))
        if rng.random() < 0.4:
            lines.append("\t COMMON line of all documents ")
        rows.append((rng.randint(2, 90), "\n".join(lines)))
    return rows


@pytest.mark.parametrize("partitions", [2, 40])
def test_against_plain(spark, partitions):
    rows = made(partitions)
    docs = spark.createDataFrame([(i, t, "r", 1, 0.5, "n") for i, t in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = line_dedup.kept_lines(docs).collect()
        whole = line_dedup.without_repeated_lines(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain(rows)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=repr) == want
    for r in got:
        n = sum(64 - bin(w.bits & (1 << 64) - 1).count("1") for w in r.keep or [])
        assert n == r.n_dropped and (r.keep is None) == (n == 0)
        assert [w.word for w in r.keep or []] == sorted({w.word for w in r.keep or []})
    assert whole[0].asDict().keys() == {"doc_id", "text", "row", "keep", "word", "n_lines"}
    assert sorted(((r.doc_id, r.text or "") for r in whole), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr)
    assert sum(r.text is None for r in whole) == sum(t is None for _, t in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert line_dedup.kept_lines(docs).collect() == [] and line_dedup.without_repeated_lines(docs).collect() == []


def test_no_python_and_one_shuffle_of_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = line_dedup.repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
