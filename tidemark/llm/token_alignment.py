"""Alignment of two tokenizers: their spans as coarse cuts, refined by the bytes of the tokens, and links counted over the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.shared import written
from tidemark.llm.tokens import byte_signs, spans

BATCH_TEXT = 1 << 20
# So many parts of texts keep their alignment in a task, and so many pairs are broadcast at most.
CACHED = 3 << 17
# So many parts are encoded in one go; groups with more links than LARGE are counted by distinct ids.
TOGETHER = 1000
LARGE = 4096
COMMON = 1 << 18
# Neither tokenizer joins what a single space between other characters parts.
SPACE = re.compile(r"(?<=\S) (?=\S)")
OTHER_SPACE = re.compile(r"^\s|\s\s|\s$|[^\S ]")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def parts_of(text: str) -> list[str]:
    """The text cut at single spaces between other characters; null and empty texts have no parts."""
    if not text:
        return []
    return SPACE.split(text) if OTHER_SPACE.search(text) else text.split(" ")


def byte_ends(token_spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where tokens end, in bytes, from their spans (begin and end in bytes, moved outwards to whole characters).

    A span is a cut where it has a width and the next one does not reach back behind its end.  The other tokens
    are some bytes of a character that they share with the next: their own lengths, from the last cut on, say where they end.
    """
    begin, end = token_spans[:, 0], token_spans[:, 1]
    coarse = (begin < end) & (end <= np.append(begin[1:], np.iinfo(np.int64).max))
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(coarse, np.arange(len(end)), -1))
    return np.where(coarse, end, total + np.where(last >= 0, end[last] - total[last], 0))


def _byte_places(text: str) -> np.ndarray:
    """Where each character of a text starts in its bytes, and where the last one ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    sizes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    return np.concatenate([[0], np.cumsum(sizes)])


def _linked(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, sizes: np.ndarray, width: int):
    """Group, pair and number of links of every token pair; in large groups equal pairs come once."""
    n_b = np.bincount(b_group, minlength=len(sizes))
    small = sizes[a_group] <= LARGE
    left, each = a_group[small], n_b[a_group[small]]
    right = spans(np.searchsorted(b_group, left), each)
    found = [(np.repeat(left, each), np.repeat(a[small], each) * width + b[right], np.ones(len(right), np.int64))]
    for g in np.flatnonzero(sizes > LARGE):
        (x, m), (y, n) = (np.unique(ids[group == g], return_counts=True) for ids, group in ((a, a_group), (b, b_group)))
        found.append((np.full(len(x) * len(y), g), (x[:, None] * width + y).ravel(), (m[:, None] * n).ravel()))
    if len(found) == 1:
        return found[0]
    group, pair, times = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(group, kind="stable")
    return group[order], pair[order], times[order]


class Aligner:
    """Both tokenizers, and the alignments of parts already met (about ``CACHED`` at most).

    Of a part ``counts`` has the numbers of tokens, groups and links, ``groups`` the groups as text, and ``pairs`` from
    ``at``, ``length`` long, the linked pairs with how often they are linked (``times``).
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {sign: bytes([i]) for i, sign in enumerate(byte_signs())}
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for sign, i in names.items():
            self.a_bytes[i] = b"".join(byte_of.get(c, c.encode()) for c in sign)
        self.width = self.b.get_piece_size()
        self.b_bytes = [self._piece(i) for i in range(self.width)]
        self.sizes = [np.array(list(map(len, table))) for table in (self.a_bytes, self.b_bytes)]
        # The ids as they stand in groups: not last and last of A's tokens, not last and last of B's.
        self.signs = [f"{i}{after}" for table, some in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for after in some for i in range(len(table))]
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.spelt = np.zeros(0, bool)
        self.counts, self.length, self.at = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, parts: list[str]) -> None:
        """Align parts, each with a space in front.  As neither tokenizer joins what the spaces part, many are encoded in one go."""
        plain, other, alone = [], [], []
        for p in parts:
            (alone if not p or p.strip() != p else plain if p.isascii() else other).append(p)
        blocks = [some[i:i + TOGETHER] for some in (plain, other) for i in range(0, len(some), TOGETHER)] + [[p] for p in alone]
        learned = []
        for block in blocks:
            found = self._align_block(block)
            learned += [(block, found)] if found else [([p], self._align_block([p])) for p in block]
        none = (np.zeros((1, 4), np.int64), [None], np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for block, _ in learned:
            self.known.update(zip(block, range(len(self.known), len(self.known) + len(block)), strict=True))
        counts, groups, length, pairs, times = zip(*[found or none for _, found in learned], strict=True)
        self.groups += chain.from_iterable(groups)
        self.spelt = np.concatenate([self.spelt, *[np.full(len(some), some[0] is not None) for some in groups]])
        self.counts = np.concatenate([self.counts, *counts])
        self.length = np.concatenate([self.length, *length])
        self.at = np.cumsum(self.length) - self.length
        self.pairs, self.times = np.concatenate([self.pairs, *pairs]), np.concatenate([self.times, *times])

    def _align_block(self, parts: list[str]):
        """Counts, groups, numbers of pairs, pairs and times of parts encoded as one text; None if a part is not spelt by its tokens."""
        text = " ".join(parts)
        whole = f" {text}"
        raw, left, right = whole.encode(), self.a.encode(whole, add_special_tokens=False), self.b.encode(text, return_type="offset_mapping")
        a_ids, b_ids = left.ids, right["ids"]
        if not b_ids or b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw:
            return None
        # In characters; those of the second tokenizer without the space that it puts in front.
        a_spans, b_spans = (np.fromiter(chain.from_iterable(x), np.int64, 2 * len(x)).reshape(-1, 2) for x in (left.offsets, right["offsets"]))
        b_spans += 1
        if len(raw) > len(whole):
            place = _byte_places(whole)
            a_spans, b_spans = place[a_spans], place[b_spans]
        a, b = np.array(a_ids), np.array(b_ids)
        a_ends, b_ends = byte_ends(a_spans, self.sizes[0][a]), byte_ends(b_spans, self.sizes[1][b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        ends = np.cumsum([len(p) + 1 for p in parts] if len(raw) == len(whole) else [len(p.encode()) + 1 for p in parts])
        to = np.searchsorted(cuts, ends)
        if to[-1] >= len(cuts) or (cuts[to] != ends).any():
            return None
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        sizes = np.bincount(a_group, minlength=len(cuts)) * np.bincount(b_group, minlength=len(cuts))
        group, pairs, times = _linked(a, b, a_group, b_group, sizes, self.width)

        def each(counted: np.ndarray) -> np.ndarray:
            return np.diff(counted, prepend=0)

        counts = np.stack([each(np.searchsorted(a_ends, ends, "right")), each(np.searchsorted(b_ends, ends, "right")), each(to + 1),
                           each(np.cumsum(sizes)[to])], axis=1)
        # The tokens in the order of the groups, those of A before those of B.
        a_to, b_to = np.searchsorted(a_ends, cuts, "right"), np.searchsorted(b_ends, cuts, "right")
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[a_to - 1], last_b[b_to - 1] = 1, 1
        n_a = len(self.a_bytes)
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + np.append(0, b_to)[a_group]] = a + last_a * n_a
        signs[np.arange(len(b)) + a_to[b_group]] = b + 2 * n_a + last_b * self.width
        words = list(map(self.signs.__getitem__, signs.tolist()))
        stops = (a_to + b_to)[to].tolist()
        groups = ["".join(words[i:j])[:-1] for i, j in zip([0, *stops], stops)]
        return counts, groups, each(np.searchsorted(group, to, "right")), pairs, times

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text the four counts and its groups; its linked pairs from ``first[i]`` to ``first[i + 1]`` with their times."""
        if len(self.known) > CACHED:
            self.forget()
        cut = [parts_of(t) for t in texts]
        flat = list(chain.from_iterable(cut))
        index = list(map(self.known.get, flat))
        new = {p for p, i in zip(flat, index, strict=True) if i is None}
        if new:
            self.learn(list(new))
            index = list(map(self.known.__getitem__, flat))
        joined = list(map(self.groups.__getitem__, index))
        index, n_parts = np.array(index, np.int64), np.array(list(map(len, cut)), np.int64)
        to = np.cumsum(n_parts)
        owner = np.repeat(np.arange(len(texts)), n_parts)
        # A text of which one part is not spelt by its tokens has none.
        whole = np.ones(len(texts), bool)
        whole[owner[~self.spelt[index]]] = False
        groups = [";".join(joined[i:j]) if ok else "" for i, j, ok in zip([0, *to.tolist()], to.tolist(), whole.tolist())]
        index, owner = index[whole[owner]], owner[whole[owner]]
        counts = np.zeros((len(texts), 4), np.int64)
        np.add.at(counts, owner, self.counts[index])
        at = spans(self.at[index], self.length[index])
        keys, which = np.unique(np.repeat(owner, self.length[index]) << 40 | self.pairs[at], return_inverse=True)
        times = np.bincount(which, self.times[at], len(keys)).astype(np.int64)
        first = np.searchsorted(keys, np.arange(len(texts) + 1) << 40)
        return counts, groups, first, keys & ((1 << 40) - 1), times


def _align(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            begin, size = 0, 0
            for i, own in enumerate(sizes):
                size += own
                if size >= BATCH_TEXT or i + 1 == len(sizes):
                    texts = batch.column("text").slice(begin, i + 1 - begin).to_pylist()
                    counts, groups, first, pairs, times = aligner.align(texts)
                    links = pa.MapArray.from_arrays(pa.array(first, pa.int32()), pa.array(pairs), pa.array(times))
                    rows = batch.slice(begin, i + 1 - begin)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("row"), rows.column("id"), *[pa.array(counts[:, c].copy()) for c in range(4)], pa.array(groups), links],
                        ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])
                    begin, size = i + 1, 0

    return run


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Per row of ``docs``: row, id, n_a, n_b, n_groups, n_links, groups and links of its text under two tokenizers.

    ``paths`` names a byte-level BPE file of tokenizers (A) and a sentencepiece model with identity normalisation (B).
    A encodes a space and the text, B the text, in front of which it puts a space itself, both without special tokens.  The byte
    offsets where tokens of both end cut the tokens into groups: ``groups`` is ``a1,a2|b1;a3|b2``, ids in order.  Every token
    of A is linked with every token of B in its group: ``links`` maps a pair (A id times the size of B's vocabulary, plus B
    id) to how often the text links it.

    Where tokens end comes from the character offsets of A and the spans of B's result record; where tokens share a character
    their bytes refine the cuts.  Texts are cut at single spaces between other characters, which no token of either covers together
    with what stands before, so each distinct part is aligned once and the alignments are joined.

    Null and empty texts, and texts that the bytes of either side's tokens do not spell, have no tokens: zeros, no groups.  Long
    texts take memory in proportion; a long part without spaces is aligned as one.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _align(*(paths or default_paths())),
        f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, links map<long, long>")


def pair_counts(groups: DataFrame, b_size: int) -> DataFrame:
    """Per linked pair: pair, n (how many documents hold it), best (is it as frequent as any of its A id).

    Counts are combined before the shuffle.  The window is over the pairs of one A id, at most one for each id of B.
    """
    counts = groups.select(F.explode("links").alias("pair", "times")).groupBy("pair").agg(F.count("*").alias("n"))
    same = Window.partitionBy(F.expr(f"pair div {b_size}L"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same))


def link_scores(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """Per row with links: row, n_best, count_sum.  Both inputs are written tables.

    The most frequent pairs, at most ``COMMON`` of them by their histogram, are broadcast; they hold most links, which are summed
    per document where they are.  The rest are joined by pair; as the frequent ones are not among them, no pair is hot.
    """
    level = F.floor(F.log2("n"))
    sizes = dict(counts.groupBy(level.alias("level")).count().collect())  # one row for each power of two
    total, least = 0, max(sizes, default=0) + 1
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > COMMON:
            break
        least = at
    common = F.broadcast(counts.where(level >= least))
    links = groups.select("row", F.explode("links").alias("pair", "times"))
    rare = links.join(common.select("pair"), "pair", "left_anti").join(counts.where(level < least), "pair")
    value = [F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")]
    found = links.join(common, "pair").select("row", *value)
    if total > COMMON:
        found = found.unionByName(rare.select("row", *value))
    return found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned(groups: DataFrame, b_size: int) -> DataFrame:
    """The rows of ``groups`` (as ``token_groups`` gives them, written) with n_best and count_sum."""
    scores = link_scores(groups, written(pair_counts(groups, b_size), "token-pairs"))
    none = F.lit(0).cast("long")
    joined = groups.join(scores.withColumnRenamed("row", "_scored"), F.col("row") == F.col("_scored"), "left")
    return joined.select(*[groups[c] for c in groups.columns], F.coalesce("n_best", none).alias("n_best"),
                         F.coalesce("count_sum", none).alias("count_sum"))


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    paths = default_paths()
    b_size = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    groups = token_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), paths=paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    table = written(groups.withColumn("groups_sha256", digest).drop("groups"), "token-groups")
    return aligned(table, b_size).select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").withColumnRenamed(
        "id", "doc_id")
