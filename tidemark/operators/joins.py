"""Interval join: equal keys, and times within a band of each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros, ms


def _band(left_time: Column, right_time: Column, before_ms: int, after_ms: int) -> Column:
    return left_time.between(
        right_time - F.expr(f"INTERVAL '{before_ms / 1000:.3f}' SECOND"),
        right_time + F.expr(f"INTERVAL '{after_ms / 1000:.3f}' SECOND"),
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    before_ms: int,
    after_ms: int,
) -> DataFrame:
    """Inner join on ``on`` where ``right_time - before <= left_time <= right_time + after``, both ends included.

    Columns come back as ``l_*`` and ``r_*``.  Time is cut into cells of the band's width; each left row is in one cell and
    each right row reaches at most two, so the equi-join key is (keys, cell): a hot key spreads over its cells, candidates per left row
    stay near its matches, and AQE can split what is still skewed.
    """
    return _join_on_cells(left, right, on, left_time, right_time, before_ms, after_ms)


def _join_on_cells(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, before_ms: int, after_ms: int
) -> DataFrame:
    width = max(1, (before_ms + after_ms) * 1000)
    cells = F.sequence(
        F.floor((micros(right_time) - before_ms * 1000) / F.lit(width)),
        F.floor((micros(right_time) + after_ms * 1000) / F.lit(width)),
    )
    lhs = _prefixed(left.where(F.col(left_time).isNotNull()).withColumn(
        "_cell", F.floor(micros(left_time) / F.lit(width))), "l_")
    rhs = _prefixed(right.where(F.col(right_time).isNotNull()).withColumn("_cell", F.explode(cells)), "r_")
    cond = F.col("l__cell") == F.col("r__cell")
    for k in on:
        cond = cond & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    cond = cond & _band(F.col(f"l_{left_time}"), F.col(f"r_{right_time}"), before_ms, after_ms)
    return lhs.join(rhs, cond, "inner").drop("l__cell", "r__cell")


def interval_join_stream(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    before_ms: int,
    after_ms: int,
    delay_ms: int,
) -> DataFrame:
    """The same join of two streams (append mode).

    The time cell is part of the key here too, so the rows of a hot key are kept by as many state partitions as it has cells, and a
    right row is kept at most twice.  Both event times stay in the condition with their watermarks, from which Spark
    tells which kept rows can no longer match, and drops them.
    """
    return _join_on_cells(left.withWatermark(left_time, ms(delay_ms)), right.withWatermark(right_time, ms(delay_ms)),
                          on, left_time, right_time, before_ms, after_ms)
