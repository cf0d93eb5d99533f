"""Count windows per key, in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import Agg, count_rows, final_columns, greatest, merged, state_columns
from tidemark.operators.scan import Split, scan


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Split | None = None) -> DataFrame:
    """Arrival number of each row within its key, from 1, as column ``_rn``."""
    return scan(df, keys, order, [count_rows("_rn")], split=split)


def count_tumbling(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, aggs: Sequence[Agg], split: Split | None = None
) -> DataFrame:
    """Every ``n`` rows of a key make a window; an incomplete last one gives no row.  ``window_no`` counts from 1."""
    size = count_rows("_size")
    rows = numbered(df, keys, order, split).withColumn("window_no", F.expr(f"(_rn - 1) div {int(n)} + 1"))
    windows = merged(rows.select(*keys, "window_no", *state_columns([size, *aggs])), [*keys, "window_no"], [size, *aggs])
    return windows.where(F.col(size.state[""]) == n).select(*keys, "window_no", *final_columns(aggs))


def count_sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    slide: int,
    aggs: Sequence[Agg],
    split: Split | None = None,
) -> DataFrame:
    """After every ``slide`` rows of a key, a window over its last ``n`` rows (fewer at the start).

    Each row is copied to the at most ceil(n/slide) windows that hold it, so a group never exceeds ``n`` rows.
    """
    latest = greatest("_rn", "_latest")
    n, slide = int(n), int(slide)
    rows = (
        numbered(df, keys, order, split)
        .withColumn("_first", F.expr(f"(_rn + {slide - 1}) div {slide}"))
        .withColumn("_final", F.expr(f"(_rn + {n - 1}) div {slide}"))
        .where("_first <= _final")
        .withColumn("window_no", F.explode(F.sequence("_first", "_final")))
    )
    windows = merged(
        rows.select(*keys, "window_no", *state_columns([latest, *aggs])), [*keys, "window_no"], [latest, *aggs]
    )
    fired = F.col(latest.state[""]) == F.col("window_no") * slide
    return windows.where(fired).select(*keys, "window_no", *final_columns(aggs))
