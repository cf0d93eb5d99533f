"""Token ids as packed matrices: best-fit-decreasing packing with a segment tree over capacities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.packing import END_ID, PART_BYTES, WINDOW
from tidemark.llm.tokens import Encoder, default_path
from tidemark.llm.words import Words, text_parts

SHARD_BYTES = 8 << 20
SHARD_IDS = 8 << 20
PAD_ID = 0
PIECE_SCHEMA = "shard long, doc_id long, text_hash long, start long, ids binary"
SCHEMA = ("sequence_id long, n_ids long, ids binary, cumulative_lengths array<int>, resets array<int>, doc_ids array<long>, "
          "starts array<long>")


class Capacities:
    """Open sequences by free room, as a segment tree that counts them; finds the least room that is large enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, sequence: int, room: int) -> None:
        self.at.setdefault(room, []).append(sequence)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A sequence with the least room of at least ``need``, and its room; it is taken out."""
        node = need + self.leaves
        if not self.count[node]:
            # Up to the first subtree on the right that is not empty, then down its left edge.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.at[room].pop(), room


def best_fit_decreasing(sizes: np.ndarray, window: int = WINDOW) -> list[list[int]]:
    """Which pieces each sequence holds: largest first, each where the least room is left."""
    rooms, out = Capacities(window), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        got = rooms.take(size)
        if got is None:
            got = (len(out), window)
            out.append([])
        out[got[0]].append(piece)
        if got[1] > size:
            rooms.put(got[0], got[1] - size)
    return out


def _pieces(path: str, shards: int):
    def pieces(batches):
        encoder = Encoder(path)
        for batch in batches:
            for keys, texts in text_parts(batch.column(0), batch.column(1), PART_BYTES):
                words = Words(texts)
                ids, before = encoder.encode(words)
                first = before[words.first]
                columns = [[], [], [], [], []]
                for i, key in enumerate(keys):
                    own = np.append(ids[first[i]:first[i + 1]], np.uint16(END_ID)).astype("<u2")
                    mark = int(np.bitwise_xor.reduce(own * np.arange(1, len(own) + 1, dtype=np.uint64)
                                                     * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1))
                    for start in range(0, len(own), WINDOW):
                        spread = (mark ^ ((key or 0) * 0x9E3779B1 + start * 0x85EBCA6B)) * 0xD6E8FEB86659FD93 >> 20
                        row = (spread % shards, key, mark, start, own[start:start + WINDOW].tobytes())
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.binary()], strict=True)],
                    ["shard", "doc_id", "text_hash", "start", "ids"])
    return pieces


def _matrix(batches):
    shard, held, rows, number = None, 0, [], 0

    def packed():
        nonlocal number
        sizes = np.array([len(r[2]) // 2 for r in rows], dtype=np.int64)
        columns = [[] for _ in range(7)]
        for members in best_fit_decreasing(sizes):
            ids = b"".join(rows[m][2] for m in members)
            n = len(ids) // 2
            ends = np.cumsum(sizes[members]).tolist()
            line = (shard * (1 << 32) + number, n, ids + np.full(WINDOW - n, PAD_ID, "<u2").tobytes(), [0, *ends],
                    [0, *ends[:-1]], [rows[m][0] for m in members], [rows[m][1] for m in members])
            number += 1
            for column, value in zip(columns, line, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()),
                 pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                          [part.split()[0] for part in SCHEMA.split(", ")])

    for batch in batches:
        for own, doc, start, ids in zip(*[batch.column(c).to_pylist() for c in ("shard", "doc_id", "start", "ids")],
                                        strict=True):
            if rows and (own != shard or held >= SHARD_IDS):
                yield packed()
                rows, held = [], 0
            if own != shard:
                shard, number = own, 0
            rows.append((doc, start, ids))
            held += len(ids) // 2
    if rows:
        yield packed()


def token_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Packed sequences of 4,096 little-endian 16-bit ids: sequence_id, n_ids, ids (padded with 0), cumulative_lengths (from 0
    to n_ids, as attention kernels take them), resets (where positions start again at 0), and per segment its doc_ids and
    starts (the document's ids before it).

    Each document is its ids and id 2.  One longer than a window is split into full windows and a rest, and nothing is lost:
    its pieces joined by ``starts`` are its ids.  Pieces are spread by a hash of id, content and place over shards of about 8
    MB of text, as many as the table needs, and each shard is packed by itself, largest piece first, each into the
    sequence with the least room that is large enough.  Whatever lands in a shard, it is packed in parts of at most
    ``SHARD_IDS`` ids, so memory is bounded.  The order inside a shard is sorted, so a task that runs again makes the same rows.

    Null and empty texts are the id 2 alone.  Rows of a repeated or null id are packed each on its own.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards = int(size // SHARD_BYTES) + 1
    pieces = texts.mapInArrow(_pieces(path or default_path(), shards), PIECE_SCHEMA)
    dealt = pieces.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "start", "text_hash")
    return dealt.mapInArrow(_matrix, SCHEMA)


def write_matrix(docs: DataFrame, folder: str, **columns: str) -> None:
    """Write the packed sequences as Parquet files, one row for each sequence, under ``folder``."""
    token_matrix(docs, **columns).write.mode("overwrite").parquet(folder)


def op1_token_matrix(spark, sf_dir: str) -> DataFrame:
    return token_matrix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
