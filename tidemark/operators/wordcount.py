"""Word counts: batch, running, and windowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Agg, count_rows
from tidemark.operators.scan import Split, scan
from tidemark.operators.windows import tumbling


def words(df: DataFrame, tokens: Column, keep: Sequence[str] = (), name: str = "word") -> DataFrame:
    """One row per token (``tidemark.functions.parse.space_tokens`` or ``word_tokens``) beside the kept columns."""
    return df.select(*keep, F.explode(tokens).alias(name))


def word_count(df: DataFrame, tokens: Column) -> DataFrame:
    """Occurrences per word.  On a stream in update mode: the running count, one row per changed word and micro-batch."""
    return words(df, tokens).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split | None = None) -> DataFrame:
    """Every row with the number of rows of its key so far: one output per input row."""
    return scan(df, keys, order, [count_rows("running_n")], split=split)


def windowed_word_count(
    df: DataFrame, tokens: Column, ts: str, size_ms: int, aggs: Sequence[Agg] | None = None
) -> DataFrame:
    """Occurrences per word and window of ``ts``, the ingest time in the usual use."""
    return tumbling(words(df, tokens, keep=[ts]), ["word"], ts, size_ms, aggs or [count_rows("n")])
