"""Order-preserving packing of documents into windows by dynamic programming."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import Encoder, default_path
from tidemark.llm.words import Words, text_parts

WINDOW = 4096
END_ID = 2
SENTENCE_PENALTY = 8
INNER_PENALTY = 16
LONGEST_GAP = 64
PART_BYTES = 1 << 23
SENTENCE_END = np.zeros(256, dtype=bool)
SENTENCE_END[[ord(c) for c in ".!?"]] = True
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indexes of the places at which windows end, at least cost.

    A window from place i to place j costs its padding, ``window - (p[j] - p[i])``, and the penalty of cutting at j.
    So cost[j] = penalty[j] + window - p[j] + min(cost[i] + p[i]) over the i within reach, and that minimum slides: a queue
    of falling candidates gives it, each place entering and leaving once.  ``places`` starts with 0, rises, and has no gap
    larger than the window.
    """
    place, penalty = places.tolist(), penalties.tolist()
    value, source = [0.0] * len(place), [0] * len(place)
    queue = deque([0])
    for j in range(1, len(place)):
        at = place[j]
        while place[queue[0]] < at - window:
            queue.popleft()
        i = queue[0]
        source[j] = i
        new = value[i] + penalty[j] + window  # value = cost + place
        value[j] = new
        while queue and value[queue[-1]] >= new:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(place) - 1
    while j > 0:
        cuts.append(j)
        j = source[j]
    return cuts[::-1]


class Stream:
    """Ids of documents one after the other: what is not yet packed."""

    def __init__(self):
        self.ids = np.zeros(0, np.uint16)
        self.docs: list[tuple[int | None, int, int]] = []  # id, its ids before the stream's part, all its ids
        self.ends = np.zeros(0, np.int64)  # where the documents end in the stream
        self.soft = np.zeros(0, np.int64)  # where sentences end

    def add(self, keys: list, words: Words, encoder: Encoder) -> None:
        ids, before = encoder.encode(words)
        first = before[words.first]
        sizes = np.diff(first)
        # Put the end id behind every document.
        out = np.full(len(ids) + len(keys), END_ID, dtype=np.uint16)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(keys)), sizes)] = ids
        closing = SENTENCE_END[words.data[words.ends - 1]] if len(words.ends) else np.zeros(0, bool)
        word_doc = np.repeat(np.arange(len(keys)), np.diff(words.first))
        soft = before[1:][closing] + word_doc[closing]
        base = len(self.ids)
        self.ids = np.concatenate([self.ids, out])
        self.docs += [(k, 0, n) for k, n in zip(keys, (sizes + 1).tolist(), strict=True)]
        self.ends = np.concatenate([self.ends, base + np.cumsum(sizes + 1)])
        self.soft = np.concatenate([self.soft, base + soft])

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Places to cut and their penalties: ends of documents, of sentences, and inside of long sentences."""
        hard = np.unique(np.concatenate([[0], self.ends, self.soft]))
        gaps = np.diff(hard)
        long = np.flatnonzero(gaps > LONGEST_GAP)
        inner = [np.arange(hard[i] + LONGEST_GAP, hard[i + 1], LONGEST_GAP) for i in long]
        places = np.unique(np.concatenate([hard, *inner])).astype(np.int64)
        penalties = np.full(len(places), float(INNER_PENALTY))
        penalties[np.searchsorted(places, self.soft)] = SENTENCE_PENALTY
        penalties[np.searchsorted(places, self.ends)] = 0
        return places, penalties

    def pack(self, last: bool, number: int) -> tuple[list, int]:
        """Rows of the windows that are settled (all if ``last``; else the last one waits for what follows)."""
        if not len(self.ids):
            return [], number
        places, penalties = self.candidates()
        cuts = places[best_cuts(places, penalties)]
        if not last:
            cuts = cuts[:-1]
        upto = int(cuts[-1]) if len(cuts) else 0
        starts = np.concatenate([[0], cuts[:-1]]) if len(cuts) else np.zeros(0, np.int64)
        edges = np.unique(np.concatenate([[0], cuts, self.ends[self.ends < upto]])).astype(np.int64)
        begin = edges[:-1]
        doc = np.searchsorted(self.ends, begin, "right").tolist()
        window = (np.searchsorted(starts, begin, "right") - 1).tolist()
        doc_starts = np.concatenate([[0], self.ends[:-1]])
        wide = self.ids.astype("<u4")
        rows = []
        for a, b, d, w in zip(begin.tolist(), edges[1:].tolist(), doc, window, strict=True):
            key, passed, total = self.docs[d]
            rows.append((key, a - int(doc_starts[d]) + passed, b - a, zlib.crc32(wide[a:b]), total, number + w,
                         a - int(starts[w])))
        # What is left: the rest of a document that was cut, and the documents after it.
        left = int(np.searchsorted(self.ends, upto, "right"))
        if left < len(self.docs):
            key, passed, total = self.docs[left]
            self.docs[left] = (key, passed + max(0, upto - int(doc_starts[left])), total)
        self.docs, self.ends = self.docs[left:], self.ends[left:] - upto
        self.ids, self.soft = self.ids[upto:], self.soft[self.soft > upto] - upto
        return rows, number + len(cuts)


def _pack(path: str):
    def pack(batches):
        encoder, stream = Encoder(path), Stream()
        number = TaskContext.get().partitionId() << 40
        names = [part.split()[0] for part in SCHEMA.split(", ")]

        def table(rows):
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for keys, texts in text_parts(batch.column(0), batch.column(1), PART_BYTES):
                stream.add(keys, Words(texts), encoder)
                rows, number = stream.pack(False, number)
                yield table(rows)
        yield table(stream.pack(True, number)[0])
    return pack


def pack_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Pieces of documents in windows of at most 4,096 ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents follow each other in the order in which the partitions of ``docs`` hold them (sort or range-partition it first
    for another order), each followed by id 2.  Windows end where padding plus penalties for cutting a document is least: ends
    of documents cost nothing, ends of sentences as much as 8 ids of padding, and every 64 ids inside a longer sentence
    16.  Each partition is packed by itself while it is read, part by part (about 8 MB of text); the last window of a part
    stays open for the next.  No shuffle takes place, and only the last window of a partition may be far from full.

    ``sequence_id`` is the partition's number times 2^40 plus the window's.  Null and empty texts are the id 2 alone.  Rows
    of a repeated or null id are packed each on its own.  No row, no piece.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_pack(path or default_path()), SCHEMA)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack_in_order(spark.read.parquet(f"{sf_dir}/documents.parquet"))
