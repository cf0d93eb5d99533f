"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import LOWER, SPACE

SIZES = (3, 4, 5, 6)
BITS = 19
SAMPLE = 30_000
FEATURES = 4096
LEAST_RATIO = 1.0
LEAST_Z = 4.0
PIECE = 1 << 20
THRESHOLD = 0.7


def features(raw: bytes):
    """Hashed n-grams of the text's bytes, lower-cased and with any white space as a space, in pieces of bounded size."""
    data = LOWER[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)]
    data[SPACE[data]] = 32
    for at in range(0, len(data), PIECE):
        part = data[at:at + PIECE + max(SIZES) - 1].astype(np.uint32)
        number = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, max(SIZES) + 1):
            if len(part) < n:
                break
            number = number[:len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:]
            if n in SIZES:
                spread = (number ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                spread ^= spread >> np.uint32(15)
                yield (spread * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)


def present(raw: bytes, weights: np.ndarray) -> np.ndarray:
    """The distinct features of the text whose weight is not 0."""
    some = [np.unique(f[weights[f] != 0]) for f in features(raw)]
    return np.unique(np.concatenate(some)) if some else np.zeros(0, dtype=np.uint32)


@dataclasses.dataclass
class Model:
    weights: np.ndarray  # one for each hashed n-gram; most are 0
    bias: float

    def score(self, raw: bytes) -> float:
        margin = self.bias + float(self.weights[present(raw, self.weights)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def _texts(batch: pa.RecordBatch):
    for text in batch.column("text").cast(pa.binary()):
        yield text.as_py() or b""


def _counts(batches):
    """Per feature: the texts of either label that hold it."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for label, raw in zip(batch.column("label").to_pylist(), _texts(batch), strict=True):
            seen = np.zeros(1 << BITS, dtype=bool)
            for f in features(raw):
                seen[f] = True
            counts[label] += seen
    some = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])],
                                     ["feature", "clean", "toxic"])


def _rows(chosen: np.ndarray):
    def rows(batches):
        for batch in batches:
            found = [present(raw, chosen).astype(np.int32).tolist() for raw in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))],
                                             ["label", "found"])
    return rows


def log_ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Naive Bayes log-count ratios; 0 where they are small, or within what chance makes of such counts."""
    p, q = (toxic + 0.5) / (n_toxic + 1), (clean + 0.5) / (n_clean + 1)
    ratio = np.log(p / q)
    both = (toxic + clean) / max(1, n_toxic + n_clean)
    spread = np.sqrt(both * (1 - both) * (1 / max(1, n_toxic) + 1 / max(1, n_clean))) + 1e-12
    z = np.abs(toxic / max(1, n_toxic) - clean / max(1, n_clean)) / spread
    ratio[(np.abs(ratio) < LEAST_RATIO) | (z < LEAST_Z)] = 0
    strength = np.abs(ratio) * z
    if np.count_nonzero(ratio) > FEATURES:
        ratio[strength < np.partition(strength[ratio != 0], -FEATURES)[-FEATURES]] = 0
    return ratio


def fit(found: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, steps: int = 400, decay: float = 1e-4):
    """Logistic regression on the ratios of the features that a text holds, by accelerated gradient descent."""
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    names, cols = np.unique(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64), return_inverse=True)
    scale = ratio[names]
    weights, bias = np.ones(len(names)) * 0.1, np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    values = scale[cols]
    # The largest curvature, by power iteration, sets the step.
    probe, curve = np.ones(len(names) + 1), 1.0
    for _ in range(30):
        probe /= np.linalg.norm(probe)
        margin = np.bincount(rows, values * probe[cols], len(labels)) + probe[-1]
        probe = np.append(np.bincount(cols, values * margin[rows], len(names)), margin.sum()) / len(labels)
        curve = np.linalg.norm(probe)
    rate, ahead, ahead_bias = 1 / (0.3 * curve + decay), weights.copy(), bias
    for step in range(steps):
        margin = np.bincount(rows, values * ahead[cols], len(labels)) + ahead_bias
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
        gradient = np.bincount(cols, values * error[rows], len(names)) / len(labels) + decay * ahead
        new, new_bias = ahead - rate * gradient, ahead_bias - rate * error.mean()
        push = step / (step + 3)
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias = new, new_bias
    full = np.zeros(len(ratio), dtype=np.float32)
    full[names] = scale * weights
    return Model(full, float(bias))


def train(docs: DataFrame, labels: DataFrame, allowed, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic") -> Model:
    """Fit the classifier on the labelled documents for which ``allowed(id column)`` holds.

    Of these at most ``SAMPLE`` (30,000, those with the smallest hash of the id) are used; that many ids are sent to the
    tasks that scan the documents, so texts are not shuffled.  The driver gets one row for each of 2^19 hashed
    n-grams, and for each sampled text at most ``FEATURES`` (4,096) numbers.  Ids labelled more than once, or with null,
    or without a document, are not used.
    """
    chosen = (labels.select(F.col(label_id).cast("long").alias("label_doc"), F.col(label_col).alias("label"))
              .where(allowed(F.col("label_doc"))).groupBy("label_doc")
              .agg(F.min("label").alias("label"), F.max("label").alias("most"), F.count("*").alias("times"))
              .where("times = 1 AND label IN (0, 1)"))
    chosen = chosen.orderBy(F.xxhash64("label_doc"), "label_doc").limit(SAMPLE)
    chosen = F.broadcast(chosen.select("label_doc", F.col("label").cast("int").alias("label")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(chosen, F.col("id") == F.col("label_doc")).select("label", "text")
    sizes = dict(sample.groupBy("label").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((n_toxic + 0.5) / (n_clean + 0.5))))
    counts = (sample.mapInArrow(_counts, "feature long, clean long, toxic long").groupBy("feature")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    clean, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    where = counts["feature"].to_numpy()
    clean[where], toxic[where] = counts["clean"].to_numpy(), counts["toxic"].to_numpy()
    ratio = log_ratios(clean, toxic, n_clean, n_toxic)
    rows = sample.mapInArrow(_rows(ratio.astype(np.float32)), "label int, found array<int>").toArrow()
    found = [np.asarray(x, dtype=np.int64) for x in rows["found"].to_pylist()]
    return fit(found, rows["label"].to_numpy().astype(float), ratio)


def scorer(spark, model: Model):
    """A column function from text to the probability of label 1 (null text: as the empty text)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = shared.value
        return pa.array([own.score(t.as_py() or b"") for t in texts.cast(pa.binary())], pa.float64())

    return score


def _known(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 != 1


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    Labels are learned from rows whose crc32(id as text) modulo 3 is not 1; see ``train``.  A score reads the text
    alone.  Every row is scored, also of empty text (null counts as empty), and rows of a repeated id each on its own; a row
    without an id is not held out, as no label can belong to it.
    """
    score = scorer(docs.sparkSession, train(docs, labels, _known, id_col, text_col))
    key = F.col(id_col).cast("long")
    out = docs.select(key.alias("doc_id"), F.coalesce(~_known(key), F.lit(False)).alias("held_out"),
                      score(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels, _known, id_col, text_col))
    return docs.where(score(F.col(text_col)) < THRESHOLD)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
