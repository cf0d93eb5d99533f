"""Benchmark decontamination by spaced seeds.

A seed looks at the words of a short span through a fixed mask; the positions the mask leaves out may hold any word.  Spans of
documents and of benchmark items with the same seed number are hits, and around each hit the two texts are compared word by
word, so copies with substituted words are found too.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Words, mix, text_parts

# Fixed masks: 1 looks at the word, 0 ignores it.  Every aligned run of 13 words or more with 0.8 equal agrees with one of
# them somewhere (a run of 26 words has such a run in one of its halves, and all of 13 to 25 words were tried).
MASKS = ("1111011", "11010001011", "1010001000111")
LEAST_WORDS = 13
LEAST_SHARE = 0.8
BLOCK_WORDS = 1 << 20
PART_WORDS = 1 << 20
SCHEMA = ("doc_id long, item_id long, doc_word long, item_word long, n_words long, n_same long, share double, "
          "item_words long")


def seed_numbers(numbers: np.ndarray, mask: str, span: int) -> np.ndarray:
    """A number for each span of ``span`` words, made of the words that the mask looks at."""
    n = len(numbers) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, len(mask) + 131 * span, dtype=np.uint64)
    for i in range(span):
        if mask[i] == "1":
            out = out * np.uint64(0xC2B2AE3D27D4EB4F) + numbers[i:i + n]
    return mix(out)


def short_masks(n: int) -> list[str]:
    """Masks over a whole item of ``n`` words, of which one agrees however the k substitutions that it may have are placed: the
    words are dealt to k + 2 groups, and a mask looks at two of them."""
    groups = n - math.ceil(LEAST_SHARE * n) + 2
    if groups == 2:
        return ["1" * n]
    return ["".join("01"[i % groups in pair] for i in range(n)) for pair in itertools.combinations(range(groups), 2)]


# What a substitution counts against a run in which a match counts 1: as much as makes ``LEAST_SHARE`` break even.
COST = round(LEAST_SHARE / (1 - LEAST_SHARE))


def best_run(same: np.ndarray, least: int = 1) -> tuple[int, int, int] | None:
    """Start, length and matches of the aligned run with the largest score among those of ``least`` words or more of which
    ``LEAST_SHARE`` are equal."""
    if len(same) < least:
        return None
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -COST))])
    low = np.minimum.accumulate(total[:len(total) - least])
    score = total[least:] - low
    end = int(np.argmax(score))
    if score[end] < 0:
        return None
    start = int(np.flatnonzero(total[:end + 1] == low[end])[-1])
    return start, end + least - start, int(same[start:end + least].sum())


def have_runs(same: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether there is a run as in ``best_run``, for many alignments (of ``sizes`` words, one after the other) at once."""
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    step = np.zeros(first[-1], dtype=np.int64)
    inside = np.ones(first[-1], dtype=bool)
    inside[first[:-1]] = False
    step[inside] = np.where(same, 1, -COST)
    line = np.repeat(np.arange(len(sizes)), sizes + 1)
    # Far enough below the line before that its least total is not taken over.
    far = 2 * COST * (len(step) + 1)
    total = np.cumsum(step) - line * far
    low = np.minimum.accumulate(total)
    at = np.arange(len(step))
    before = at - least[line]
    within = before >= first[line]
    good = np.flatnonzero(within)[total[within] >= low[before[within]]]
    return np.bincount(line[good], minlength=len(sizes)) > 0


class Seeds:
    """Seed numbers of a block of benchmark items, sorted, with where they stand."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        words = Words([(t or "").encode() for _, t in items])
        self.numbers, self.first = words.numbers, words.first
        sizes = np.diff(self.first)
        item_of = np.repeat(np.arange(len(items)), sizes)
        # Items of fewer words than a run must have are looked up as a whole, by masks of their length.
        short = sorted({int(x) for x in sizes if 0 < x < LEAST_WORDS})
        own = [(m, n) for n in short for m in short_masks(n)]
        self.shapes = [(m, len(m)) for m in MASKS] + own
        keys, places = [], []
        for k, (mask, n) in enumerate(self.shapes):
            key = seed_numbers(self.numbers, mask, n)
            at = np.arange(len(key))
            whole = (item_of[at] == item_of[at + n - 1]) if len(key) else np.zeros(0, bool)
            if len(key):
                size = sizes[item_of[at]]
                whole &= (size >= LEAST_WORDS) if k < len(MASKS) else (size == n)
            keys.append(key[whole])
            places.append(at[whole])
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(key, kind="stable")
        self.keys, self.places = key[order], place[order]
        self.item_of = item_of
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.keys >> np.uint64(44)).astype(np.int64)] = True


def _search(seeds: Seeds, words: Words, mask: str, span: int):
    """Pairs (word in the batch, word in the block) with equal seeds."""
    key = seed_numbers(words.numbers, mask, span)
    may = np.flatnonzero(seeds.filter[(key >> np.uint64(44)).astype(np.int64)])
    low = np.searchsorted(seeds.keys, key[may], "left")
    high = np.searchsorted(seeds.keys, key[may], "right")
    n = high - low
    hit = n > 0
    may, low, n = may[hit], low[hit], n[hit]
    at = np.repeat(may, n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at, seeds.places[np.repeat(low, n) + offset]


def _verified(seeds: Seeds, words: Words, lines: np.ndarray) -> np.ndarray:
    """The columns (document, item, shift) of ``lines`` whose texts have a run that counts as an overlap."""
    doc, item, shift = lines
    a, b = seeds.first[item], seeds.first[item + 1]
    low, high = np.maximum(a, words.first[doc] - shift), np.minimum(b, words.first[doc + 1] - shift)
    least = np.minimum(LEAST_WORDS, b - a)
    lines, low, sizes, least = (x[..., high - low >= least] for x in (lines, low, high - low, least))
    part = np.cumsum(sizes) // PART_WORDS
    out = []
    for k in np.unique(part):
        own = part == k
        size = sizes[own]
        at = np.arange(size.sum()) + np.repeat(low[own] - (np.cumsum(size) - size), size)
        same = seeds.numbers[at] == words.numbers[at + np.repeat(lines[2, own], size)]
        out.append(lines[:, own][:, have_runs(same, size, least[own])])
    return np.concatenate([np.zeros((3, 0), np.int64), *out], axis=1)


def _overlaps(seeds: Seeds):
    def overlaps(batches):
        for batch in batches:
            for ids, texts in text_parts(batch.column(0), batch.column(1)):
                words = Words(texts)
                found = [_search(seeds, words, m, n) for m, n in seeds.shapes]
                at = np.concatenate([f[0] for f in found])
                place = np.concatenate([f[1] for f in found])
                doc = np.searchsorted(words.first, at, "right") - 1
                item = seeds.item_of[place]
                # One comparison for each document, item and alignment.
                lines = np.unique(np.stack([doc, item, at - place]), axis=1)
                rows = []
                for d, i, shift in _verified(seeds, words, lines).T.tolist():
                    a, b = int(seeds.first[i]), int(seeds.first[i + 1])
                    low, high = max(a, int(words.first[d]) - shift), min(b, int(words.first[d + 1]) - shift)
                    same = seeds.numbers[low:high] == words.numbers[low + shift:high + shift]
                    start, n, matches = best_run(same, min(LEAST_WORDS, b - a))
                    rows.append((ids[d], seeds.ids[i], low + start + shift - int(words.first[d]), low + start - a, n,
                                 matches, matches / n, b - a))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
                kinds = [pa.int64()] * 6 + [pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [part.split()[0] for part in SCHEMA.split(", ")])
    return overlaps


def _blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, streamed to the driver one after the other."""
    block, size = [], 0
    for item, text in benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).toLocalIterator():
        block.append((item, text))
        size += len(text or "") // 4 + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every overlap of a document with a benchmark item: ids, first word in either, words, equal words, their share, and the
    item's length.

    An overlap is an aligned run of at least 13 words (or of the whole item, if shorter) of which at least 0.8 are equal;
    words and lower-casing as in ``words``.  The benchmark is the query set: it is sent to the tasks in blocks of bounded size
    (``BLOCK_WORDS``), each block is compared with all documents, and the documents are never shuffled.  The seeds miss no such run; each document, item and alignment gives one row, its run with the
    largest score (a substitution counts 4 against it).  An item in any
    share of the documents, or many times in one, needs nothing special.  Null and empty texts overlap with
    nothing; rows of a repeated id are compared each on its own; a null id is returned as null.
    """
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    spark, out = docs.sparkSession, None
    for block in _blocks(benchmark, item_id, item_text):
        if not any((t or "").split() for _, t in block):
            continue
        found = texts.mapInArrow(_overlaps(Seeds(block)), SCHEMA)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def without_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id has no overlap with the benchmark, with all their columns."""
    found = overlaps(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_found_id")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["_found_id"]), "left_anti")


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
