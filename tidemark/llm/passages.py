"""Passages that repeat across documents: equal runs of words at any place, and MinHash banding of paragraphs.

Equal runs are found by anchors, word 12-shingles of which the smallest number among any 13 in a row is taken (winnowing), so
that equal runs of 24 words have an anchor in common wherever they stand.  Around anchors that several documents have, all
windows of 24 words are looked up, and beside those that repeat, the windows of 12 words.

The paragraphs compared are sentences of 8 words or more, and the runs of shorter sentences between them.  A paragraph of
changed words is found by its bands, exact Jaccard and components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.linking import bitmap, likely_pairs, linked_components, possible, shared_tiles
from tidemark.llm.shared import dropped, written
from tidemark.llm.words import Words, mix, text_parts

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.98
LEAST_UNIT = 8
LEAST_BANDED = 20
LEAST_PASSAGE = 30
GAP = 7
LEAST_RUN = 24
ANCHOR = 12
UNIT_SCHEMA = "doc_id long, start long, n_words long, node long, bands array<long>"
SENTENCE_END = np.zeros(256, dtype=bool)
SENTENCE_END[[ord(c) for c in ".!?"]] = True


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, most: int = 8) -> tuple[int, int]:
    """Bands and rows of a band with the fewest bands that find a pair of this similarity with this probability.

    Bands of one row are not considered: they would bring unlike paragraphs together."""
    options = []
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
        options.append((bands, -rows))
    bands, rows = min(options)
    return bands, -rows


BANDS, ROWS = bands_for()


def paragraphs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every paragraph of at least ``LEAST_UNIT`` words in the batch."""
    n = len(words.numbers)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stop = SENTENCE_END[words.data[words.ends - 1]]
    lines = np.concatenate([[0], np.cumsum(words.data == 10)])
    following = np.append(words.starts[1:], len(words.data))
    broken = lines[following] > lines[words.ends]
    broken[words.first[1:][words.first[1:] > 0] - 1] = True  # ends of texts
    stop |= broken
    stop[-1] = True
    ends = np.flatnonzero(stop) + 1
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= LEAST_UNIT
    # Short sentences are joined unless a line or text ends between them.
    joins = ~long[1:] & ~long[:-1] & ~broken[ends[:-1] - 1]
    begin = np.concatenate([[True], ~joins])
    starts, ends = starts[begin], ends[np.append(begin[1:], True)]
    keep = ends - starts >= LEAST_UNIT
    return starts[keep], ends[keep]


def _units(batches):
    factors = [np.uint64(int(mix(np.array([k + 1], np.uint64))[0]) | 1) for k in range(BANDS * ROWS)]
    for batch in batches:
        for ids, texts in text_parts(batch.column(0), batch.column(1)):
            words = Words(texts)
            a, b = paragraphs(words)
            shingles = words.shingles(WIDTH)
            doc = np.searchsorted(words.first, a, "right") - 1
            place = np.uint64(0x9E3779B97F4A7C15)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(shingles)])
            # The paragraph's own number: its shingles in order of place.
            steps = np.arange(len(shingles), dtype=np.uint64)
            moved = np.concatenate([np.zeros(1, np.uint64), np.cumsum(shingles * steps)])
            last = b - WIDTH + 1
            plain = total[last] - total[a]
            node = mix(moved[last] - moved[a] - a.astype(np.uint64) * plain + mix(plain + (b - a).astype(np.uint64) * place))
            wide = np.flatnonzero(b - a >= LEAST_BANDED)
            keys = np.zeros((len(wide), BANDS), dtype=np.uint64)
            if len(wide):
                cuts = np.stack([a[wide], last[wide]], axis=1).ravel()
                for k, factor in enumerate(factors):
                    spread = np.append((shingles ^ (factor >> np.uint64(7))) * factor, np.uint64((1 << 64) - 1))
                    least = np.minimum.reduceat(spread, cuts)[::2]
                    keys[:, k // ROWS] = mix(keys[:, k // ROWS] * place + least + np.uint64(k // ROWS))
            counts = np.zeros(len(a) + 1, dtype=np.int32)
            counts[wide + 1] = BANDS
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(ids, dtype=object)[doc], pa.int64()), pa.array(a - words.first[doc]), pa.array(b - a),
                pa.array(node.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(keys.ravel().view(np.int64))),
            ], ["doc_id", "start", "n_words", "node", "bands"])


def anchors(words: Words) -> np.ndarray:
    """First words of the anchors: shingles with the smallest number among some ``LEAST_RUN - ANCHOR + 1`` in a row of a text."""
    shingles, across = mix(words.shingles(ANCHOR)), LEAST_RUN - ANCHOR + 1
    n = len(shingles)
    if n < across:
        return np.zeros(0, np.int64)
    text = np.searchsorted(words.first, np.arange(n + ANCHOR - 1), "right") - 1
    windows = np.lib.stride_tricks.sliding_window_view
    inside = text[:n - across + 1] == text[LEAST_RUN - 1:]
    least = np.where(inside, windows(shingles, across).min(axis=1), np.uint64(0))
    around = np.pad(least, across - 1)
    return np.flatnonzero((windows(around, across).max(axis=1) == shingles) & (shingles > 0))


def _anchors(batches):
    for batch in batches:
        for ids, texts in text_parts(batch.column(0), batch.column(1)):
            words = Words(texts)
            at = anchors(words)
            doc = np.searchsorted(words.first, at, "right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(ids, dtype=object)[doc], pa.int64()), pa.array(at - words.first[doc]),
                pa.array(words.shingles(ANCHOR)[at].view(np.int64)),
            ], ["doc_id", "start", "key"])


def _windows(size: int):
    """The windows of ``size`` words that start in the given ranges [low, high] of each text."""
    def windows(batches):
        for batch in batches:
            ranges = batch.column("ranges").to_pylist()
            at = 0
            for ids, texts in text_parts(batch.column("doc_id"), batch.column("text")):
                words = Words(texts)
                shingles = words.shingles(size)
                docs, starts, keys = [], [], []
                for i, key in enumerate(ids):
                    a, n = int(words.first[i]), int(words.first[i + 1] - words.first[i]) - size + 1
                    if n <= 0:
                        continue
                    own = ranges[at + i]
                    edge = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edge, np.clip([r["low"] for r in own], 0, n), 1)
                    np.add.at(edge, np.clip([r["high"] + 1 for r in own], 0, n), -1)
                    place = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                    docs.append(np.full(len(place), key, dtype=np.int64))
                    starts.append(place)
                    keys.append(shingles[a + place])
                at += len(ids)
                if docs:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(docs)), pa.array(np.concatenate(starts)),
                        pa.array(np.concatenate(keys).view(np.int64))], ["doc_id", "start", "key"])
    return windows


def _repeated(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, start, key) whose key several documents have, with the smallest of these as ``keep``, and the written
    table of such keys, to be dropped when the rows have been read."""
    named = keyed.groupBy(F.col("key").alias("named")).agg(F.min("doc_id").alias("keep"), F.max("doc_id").alias("most"))
    named = written(named.where("keep < most"), "repeated")  # by itself, so that Spark can split the join at a frequent key
    return keyed.join(named, F.col("key") == F.col("named")).select("doc_id", "start", "key", "keep"), named


def joined(found: DataFrame, gap: int) -> DataFrame:
    """Rows (doc_id, start, n_words, cluster_id, keep, removed) of a document with at most ``gap`` words between, as one."""
    order = Window.partitionBy("doc_id", "removed").orderBy("start", "n_words")
    before = F.max(F.col("start") + F.col("n_words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("opens", F.coalesce(F.col("start") - before > gap, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "removed", "run").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("n_words")) - F.min("start")).alias("n_words"),
        F.min("cluster_id").alias("cluster_id"), F.min("keep").alias("keep")).drop("run")


def equal_runs(texts: DataFrame) -> DataFrame:
    """Runs of words (doc_id, start, n_words, cluster_id, keep, removed) all of whose windows of ``LEAST_RUN`` words occur in
    several documents, and the repeated windows of ``ANCHOR`` words near them.

    No run is lost: windows around every repeated anchor are looked up by number, and documents are never compared in
    pairs.  keep is the smallest id that has a window of the run, and cluster_id its smallest window number.
    """
    def looked_up(places: DataFrame, size: int, *read: DataFrame) -> DataFrame:
        ranges = places.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
        around = texts.join(ranges, F.col("doc_id") == F.col("of")).select("doc_id", "text", "ranges")
        keyed = written(around.mapInArrow(_windows(size), "doc_id long, start long, key long"), "windows")
        for table in read:
            dropped(table)
        found, keys = _repeated(keyed)
        found = found.select("doc_id", "start", F.lit(size).cast("long").alias("n_words"),
                             F.col("key").alias("cluster_id"), "keep", (F.col("doc_id") != F.col("keep")).alias("removed"))
        runs = written(joined(found, 0), "runs")
        dropped(keyed)
        dropped(keys)
        return runs

    keyed = written(texts.mapInArrow(_anchors, "doc_id long, start long, key long"), "anchors")
    places, keys = _repeated(keyed)
    places = places.select("doc_id", (F.col("start") - (LEAST_RUN - ANCHOR)).alias("low"), F.col("start").alias("high"))
    runs = looked_up(places, LEAST_RUN, keyed, keys)
    end, reach = F.col("start") + F.col("n_words"), GAP + LEAST_RUN
    beside = runs.select("doc_id", (F.col("start") - reach).alias("low"), (F.col("start") - ANCHOR).alias("high")).union(
        runs.select("doc_id", end.alias("low"), (end + reach - ANCHOR).alias("high")))
    return runs.unionByName(looked_up(beside, ANCHOR))


def _shingle_sets(batches):
    for batch in batches:
        wanted = batch.column("wanted").to_pylist()
        at = 0
        for _, texts in text_parts(batch.column("doc_id"), batch.column("text")):
            words = Words(texts)
            shingles = words.shingles(WIDTH)
            nodes, sets, sizes, bits = [], [], [], []
            for i in range(len(texts)):
                for unit in wanted[at + i]:
                    a = int(words.first[i]) + unit["start"]
                    own = np.unique(shingles[a:a + unit["n_words"] - WIDTH + 1])
                    nodes.append(unit["node"])
                    sets.append(own.tobytes())
                    sizes.append(len(own))
                    bits.append(bitmap(own))
            at += len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(bits, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                                             ["node", "n", "bits", "elements"])


def _similar(batches):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
            same = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(same >= SIMILARITY * (len(both) - same))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of ``LEAST_PASSAGE`` words or more that occur in several documents, one row for each occurrence: doc_id,
    start_word, n_words, cluster_id, keep_doc_id, removed.

    Equal runs of 24 words or more are found wherever they start (``equal_runs``).  Equal paragraphs are one class.  Paragraphs of 20 words or more also get MinHash bands (``bands_for``: 4 bands of 2 rows
    find a pair of similarity 0.8 with probability 0.98); classes that share a band are joined, their word 5-shingle sets
    are compared exactly (Jaccard 0.8 or more), and links are closed to components (``linked_components``).  A cluster
    that occurs in one document only is no repetition.  Runs and paragraphs of clusters that follow each other in a
    document, with at most 7 words between, make a passage.  What the smallest id of its cluster or window holds stays, and is
    marked as removed elsewhere; a passage that stays may overlap a removed one.  cluster_id is the smallest class or window in it.

    Null and empty texts have no paragraphs.  Rows without an id are left out; rows of a repeated id are one document.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    units = written(texts.mapInArrow(_units, UNIT_SCHEMA), "units")

    # Classes that meet in a band: looked for by key alone, then fetched.
    keys = units.where("size(bands) > 0").select("node", F.explode("bands").alias("tile"))
    mixed = keys.groupBy("tile").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    tiles = written(shared_tiles(keys.join(mixed.select("tile"), "tile").select("tile", "node").distinct()), "tiles")
    used = tiles.select(F.col("node").alias("used")).distinct()
    one = (units.join(used, F.col("node") == F.col("used"), "left_semi").groupBy("node")
           .agg(F.min("doc_id").alias("unit_doc"), F.min_by("start", "doc_id").alias("start"), F.min("n_words").alias("n_words")))
    wanted = one.groupBy("unit_doc").agg(F.collect_list(F.struct("node", "start", "n_words")).alias("wanted"))
    sets = texts.join(wanted, F.col("doc_id") == F.col("unit_doc")).select("doc_id", "text", "wanted")
    sets = written(sets.mapInArrow(_shingle_sets, "node long, n long, bits array<long>, elements binary").dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("node").alias("a_node"), F.col("elements").alias("x"))
        b = sets.select(F.col("node").alias("b_node"), F.col("elements").alias("y"))
        likely = likely_pairs(pairs, sets.select("node", "n", "bits"), possible(4, 5))
        full = likely.join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node"))
        return full.select("a", "b", "x", "y").mapInArrow(_similar, "a long, b long")

    near = linked_components(tiles, verified, sets.select("node", "n", "bits"), possible(4, 5))
    near = written(near, "near")
    dropped(sets)
    dropped(tiles)

    # Where each cluster occurs.
    classes = units.groupBy(F.col("node").alias("class")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    named = classes.join(near, F.col("class") == F.col("node"), "left").where("low < high OR component IS NOT NULL")
    named = written(named.select("class", F.coalesce("component", "class").alias("cluster"), "low", "high"), "named")
    clusters = (named.groupBy(F.col("cluster").alias("cluster_id")).agg(F.min("low").alias("keep"), F.max("high").alias("most"))
                .where("keep < most"))
    marked = named.join(clusters, F.col("cluster") == F.col("cluster_id")).select("class", "cluster_id", "keep")
    found = units.select("doc_id", "start", "n_words", "node").join(marked, F.col("node") == F.col("class"))

    # Neighbouring paragraphs and runs of a document make a passage.
    found = found.select("doc_id", "start", "n_words", "cluster_id", "keep", (F.col("doc_id") != F.col("keep")).alias("removed"))
    passages = joined(found.unionByName(equal_runs(texts)), GAP).where(F.col("n_words") >= LEAST_PASSAGE)
    return passages.select("doc_id", F.col("start").alias("start_word"), "n_words", "cluster_id",
                           F.col("keep").alias("keep_doc_id"), "removed")


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
