"""A pipeline over ``documents``: toxic ones go, then copies, near copies and benchmark text, and what is left is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of
the next stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_overlaps
from tidemark.llm.exact import exact_dedup
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.packing import pack_in_order
from tidemark.llm.shared import written
from tidemark.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no text of the benchmark."""
    return without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in windows of 4,096 ids."""
    return pack_in_order(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", benchmark),
    ("packing", packing),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
