"""Similarity join of documents on sets of word 3-shingles: size-banded tiles, hashed bitmaps, exact intersection.

Two sets of sizes x <= y with 100 * intersection >= 90 * union differ in at most (x + y) / 19 elements, and y <= x / 0.9.  So
sizes fall into bands whose ends grow by 1 / 0.9, and only sets of the same or of neighbouring bands can link.  In a pair of
bands at most k elements differ.  The hash space is cut into k + 2 equal ranges; two linked sets have at least two ranges
with the same content.  A tile is (pair of bands, range, content of the range); linked sets always meet in a tile, and other
sets hardly ever do, however common their single shingles are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.linking import bitmap, likely_pairs, linked_components, possible, shared_tiles
from tidemark.llm.shared import written
from tidemark.llm.words import Words, mix, shingle_numbers, text_parts

WIDTH = 3
SET_SCHEMA = "doc_id long, n long, d1 long, d2 long, tiles array<long>"
PAYLOAD_SCHEMA = "doc_id long, n long, bits array<long>, elements binary"


def band_of(n: int) -> tuple[int, int, int]:
    """Number, first size and end (exclusive) of the band of size ``n``."""
    band, low = 0, 1
    while True:
        high = 10 * low // 9 + 1
        if n < high:
            return band, low, high
        band, low = band + 1, high


def most_different(high: int) -> int:
    """Most elements in which two linked sets differ, the smaller of them being below ``high`` (its band's end)."""
    small = high - 1
    return (small + 10 * small // 9) // 19


def tile_keys(elements: np.ndarray) -> list[np.ndarray]:
    """Keys of the tiles of a set of sorted 64-bit numbers: with the next band, and with the band before.

    Ranges without an element are left out unless so many of them are empty that two linked sets might agree in empty
    ranges alone.
    """
    band, low, high = band_of(len(elements))
    before = [] if band == 0 else [(band - 1, low)]
    out = []
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements))])
    for number, end in [(band, high), *before]:
        k = most_different(end)
        if k == 0:  # linked sets are equal
            continue
        ranges = k + 2
        borders = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
        cut = np.concatenate([[0], np.searchsorted(elements, borders), [len(elements)]])
        size = np.diff(cut)
        content = total[cut[1:]] - total[cut[:-1]]
        place = np.arange(ranges, dtype=np.uint64) + np.uint64(number << 32)
        keys = mix(content + mix(place))
        empty = size == 0
        out.append(keys if empty.sum() >= 2 else keys[~empty])
    return out


def doc_sets(texts: list[bytes]):
    """The sorted distinct shingle numbers of each text; a text of one or two words is one shingle."""
    words = Words(texts)
    shingles = words.shingles(WIDTH)
    for i in range(len(texts)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if b - a >= WIDTH:
            yield np.unique(shingles[a:b - WIDTH + 1])
        elif b > a:
            yield shingle_numbers(words.numbers[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _sets(batches):
    for batch in batches:
        for ids, texts in text_parts(batch.column(0), batch.column(1)):
            sizes, d1, d2, keys, lengths = [], [], [], [], []
            for elements in doc_sets(texts):
                own = tile_keys(elements) if len(elements) else []
                sizes.append(len(elements))
                d1.append(np.sum(mix(elements)))
                d2.append(np.sum(mix(elements ^ np.uint64(0x5851F42D4C957F2D))))
                keys.extend(own)
                lengths.append(sum(map(len, own)))
            flat = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ], ["doc_id", "n", "d1", "d2", "tiles"])


def _payload(batches):
    for batch in batches:
        for ids, texts in text_parts(batch.column(0), batch.column(1)):
            sizes, bits, elements = [], [], []
            for own in doc_sets(texts):
                sizes.append(len(own))
                bits.append(bitmap(own))
                elements.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bits, pa.list_(pa.int64())),
                pa.array(elements, pa.binary()),
            ], ["doc_id", "n", "bits", "elements"])


def _linked(batches):
    """Keep the pairs whose sorted arrays intersect enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate([x, y]))
            same = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * same >= 90 * (len(x) + len(y) - same))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _side(payload: DataFrame, side: str, name: str) -> DataFrame:
    return payload.select(F.col("doc_id").alias(f"{side}_id"), F.col("elements").alias(name))


def _verified(pairs: DataFrame, payload: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link: bitmaps first, and the arrays only of what the bitmaps leave."""
    facts = payload.select(F.col("doc_id").alias("node"), "n", "bits")
    full = (likely_pairs(pairs, facts, possible(9, 10))
            .join(_side(payload, "a", "x"), F.col("a") == F.col("a_id"))
            .join(_side(payload, "b", "y"), F.col("b") == F.col("b_id")).select("a", "b", "x", "y"))
    return full.mapInArrow(_linked, "a long, b long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id that links reach).

    1. Equal sets become one class, named by its smallest id; the rest works on classes.
    2. Classes meet in tiles (see the module).  Tiles of one class are dropped by a count before the shuffle.
    3. Classes are compared with the hubs of their tiles, and where that leaves several components in a tile, in full (see
       ``linked_components``).  No link is lost, and a large group of near copies is linked without its pairs.

    A comparison bounds the intersection by bit counts and then intersects the sorted arrays.  Empty texts (null counts as
    empty) have an empty set and link with nothing.  Rows of a repeated id are one node.  A row without an id takes
    the component of a row with the same set and no other.  Shingles are 64-bit numbers, classes 128-bit ones.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = written(texts.mapInArrow(_sets, SET_SCHEMA), "sets")
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("node"), F.first("tiles").alias("tiles"))
    tiles = written(shared_tiles(classes.select("node", F.explode("tiles").alias("tile"))), "tiles")
    used = tiles.select(F.col("node").alias("used")).distinct()
    payload = written(texts.join(used, F.col("doc_id") == F.col("used"), "left_semi").mapInArrow(_payload, PAYLOAD_SCHEMA)
                      .dropDuplicates(["doc_id"]), "payload")
    facts = payload.select(F.col("doc_id").alias("node"), "n", "bits")
    final = linked_components(tiles, lambda pairs: _verified(pairs, payload), facts, possible(9, 10))

    names = classes.select(F.col("n").alias("class_n"), F.col("d1").alias("class_1"), F.col("d2").alias("class_2"), "node")
    members = sets.join(names, (F.col("n") == F.col("class_n")) & (F.col("d1") == F.col("class_1"))
                        & (F.col("d2") == F.col("class_2")), "left").select("doc_id", "n", F.col("node").alias("class"))
    out = members.join(final, F.col("class") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component", "class", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which no smaller id is in the same component, with all their columns."""
    kept = ngram_join(docs, id_col, text_col).where("doc_id = component_id OR doc_id IS NULL AND component_id IS NULL")
    kept = kept.select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
