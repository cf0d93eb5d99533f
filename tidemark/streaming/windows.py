"""Stream forms that Spark's built-in stateful operators cover.

Append mode gives one row per window once the watermark passes its end; update mode gives a row per change before that.
Spark drops late rows by the watermark of the previous micro-batch, so a row may be kept here that the row-by-row rule of
``tidemark.operators.watermark`` calls late; final results agree whenever disorder stays within the delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Agg, final_columns, merged, state_columns
from tidemark.functions.times import ms
from tidemark.operators.windows import tumbling


def windowed_stream(
    df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, aggs: Sequence[Agg], delay_ms: int,
    lateness_ms: int = 0, slide_ms: int | None = None,
) -> DataFrame:
    """Tumbling or sliding windows of a stream.  With lateness use update mode: windows stay open for delay plus lateness
    and every change emits them again; the last row of a window is its final answer."""
    return tumbling(df.withWatermark(ts, ms(delay_ms + lateness_ms)), keys, ts, size_ms, aggs, slide_ms)


def session_stream(df: DataFrame, keys: Sequence[str], ts: str, gap_ms: int, aggs: Sequence[Agg], delay_ms: int) -> DataFrame:
    """Session windows of a stream (append mode; Spark refuses update mode for sessions)."""
    states = df.withWatermark(ts, ms(delay_ms)).select(*keys, ts, *state_columns(aggs))
    out = merged(states, [*keys, F.session_window(ts, ms(gap_ms)).alias("window")], aggs)
    return out.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *final_columns(aggs)
    )


def stamp_ingest(df: DataFrame, name: str = "ingest") -> DataFrame:
    """Processing time as a column: one instant per micro-batch.  Windows over it are processing-time windows."""
    return df.withColumn(name, F.current_timestamp())


def split_by_clock(df: DataFrame, ts: str, lag_ms: int) -> tuple[DataFrame, DataFrame]:
    """Rows within ``lag_ms`` of the wall clock, and rows older than that (or without a time)."""
    fresh = F.coalesce(F.unix_micros(F.col(ts)) > F.unix_micros(F.current_timestamp()) - F.lit(lag_ms * 1000), F.lit(False))
    return df.where(fresh), df.where(~fresh)
