"""Time windows over a keyed table or stream: tumbling, sliding, and ordered window content."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import (
    Agg, count_rows, final_columns, joined, merged, merges, state_columns, state_names,
)
from tidemark.functions.times import micros, ms
from tidemark.operators.scan import BUCKET, Split, scan


def window_start(ts: Column | str, size_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window that holds ``ts``."""
    us = micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(size_ms * 1000)))


COPIES, PANES, BLOCKS = "copies", "panes", "blocks"


def tumbling(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size_ms: int,
    aggs: Sequence[Agg],
    slide_ms: int | None = None,
    overlap: str = PANES,
) -> DataFrame:
    """Aggregates per key and window ``[window_start, window_end)``; with ``slide_ms`` each row is in several windows.

    Works on a table, and on a stream whose ``ts`` carries a watermark.  One shuffle of partial aggregates.  For overlapping
    windows of a table ``overlap`` says how; the results are the same.

    * ``copies``: each row goes into its windows before the partial aggregation.  One shuffle; for a few windows per row.
    * ``panes``: rows are aggregated in panes as wide as the greatest common divisor of size and slide, and the panes' partial
      aggregates go into their windows in a second shuffle.
    * ``blocks``: time is cut into blocks as long as a window, so a window is a tail of one block and a head of the next.
      Both are running aggregates over panes, and a window is made of at most two states however many windows overlap.  For
      long windows with short steps, and for aggregates that can run over a frame (not joined texts or folds).
    """
    slide = slide_ms or size_ms
    if overlap not in (COPIES, PANES, BLOCKS):
        raise ValueError(f"overlap must be {COPIES}, {PANES} or {BLOCKS}")
    if slide < size_ms and not df.isStreaming and overlap != COPIES:
        return (_from_panes if overlap == PANES else _from_blocks)(df, keys, ts, size_ms, slide, aggs)
    if slide > size_ms:
        # Windows with gaps between them: rows in a gap belong to none.
        df = df.where(F.pmod(micros(ts), F.lit(slide * 1000)) < size_ms * 1000)
    states = df.select(*keys, ts, *state_columns(aggs))
    windows = merged(states, [*keys, F.window(ts, ms(max(size_ms, slide)), ms(slide)).alias("window")], aggs)
    start = F.col("window.start")
    end = F.timestamp_micros(micros(start) + F.lit(size_ms * 1000)) if slide > size_ms else F.col("window.end")
    return windows.select(*keys, start.alias("window_start"), end.alias("window_end"), *final_columns(aggs))


def sliding(
    df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, slide_ms: int, aggs: Sequence[Agg], overlap: str = PANES
) -> DataFrame:
    """Windows of ``size_ms`` that start every ``slide_ms``; see :func:`tumbling`."""
    return tumbling(df, keys, ts, size_ms, aggs, slide_ms, overlap)


def _panes(df: DataFrame, keys: Sequence[str], ts: str, pane_ms: int, aggs: Sequence[Agg]) -> DataFrame:
    states = df.where(F.col(ts).isNotNull()).select(*keys, window_start(ts, pane_ms).alias("_pane"), *state_columns(aggs))
    return merged(states, [*keys, "_pane"], aggs)


def _from_blocks(df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, slide_ms: int, aggs: Sequence[Agg]) -> DataFrame:
    names, size, slide = state_names(aggs), size_ms * 1000, slide_ms * 1000
    panes = _panes(df, keys, ts, math.gcd(size_ms, slide_ms), aggs).withColumn("_at", micros("_pane")).drop("_pane")
    panes = panes.withColumns({"_block": F.floor(F.col("_at") / F.lit(size)) * size, "_start": F.lit(None).cast("bigint"), "_tail": F.lit(None).cast("boolean")})
    # In each block: windows that start in it ask for its panes from there on, those that started in the block before and end in
    # it for its panes up to there.
    blocks = panes.select(*keys, "_block").distinct()
    first = F.ceil((F.col("_block") - size + 1) / F.lit(slide)) * slide
    last = F.floor((F.col("_block") + size - 1) / F.lit(slide)) * slide
    asked = blocks.withColumn("_start", F.explode(F.when(first <= last, F.sequence(first.cast("bigint"), last.cast("bigint"), F.lit(slide).cast("bigint")))))
    asked = asked.withColumn("_tail", F.col("_start") >= F.col("_block"))
    asked = asked.withColumn("_at", F.when(F.col("_tail"), F.col("_start")).otherwise(F.col("_start") + size))
    both = panes.unionByName(asked, allowMissingColumns=True)
    question = F.col("_start").isNotNull()
    by = Window.partitionBy(*keys, "_block")
    # A tail takes in the pane at its start, a head not the pane at its end.
    tails = by.orderBy(F.col("_at").desc(), question.asc()).rowsBetween(Window.unboundedPreceding, 0)
    heads = by.orderBy(F.col("_at").asc(), question.desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = both
    for frame, mark in ((tails, "t"), (heads, "h")):
        found = found.select("*", *[c.over(frame).alias(f"_{mark}{n}") for n, c in merges(aggs)],
                             F.count(F.when(~question, 1)).over(frame).alias(f"_{mark}_panes"))
    tail = F.col("_tail")
    found = found.where(question).where(F.when(tail, F.col("_t_panes")).otherwise(F.col("_h_panes")) > 0).select(
        *keys, F.timestamp_micros("_start").alias("window_start"), *[F.when(tail, F.col(f"_t{n}")).otherwise(F.col(f"_h{n}")).alias(n) for n in names])
    return _finished(merged(found, [*keys, "window_start"], aggs), keys, size_ms, aggs)


def _finished(windows: DataFrame, keys: Sequence[str], size_ms: int, aggs: Sequence[Agg]) -> DataFrame:
    end = F.timestamp_micros(micros("window_start") + F.lit(size_ms * 1000))
    return windows.select(*keys, "window_start", end.alias("window_end"), *final_columns(aggs))


def _from_panes(df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, slide_ms: int, aggs: Sequence[Agg]) -> DataFrame:
    names, pane_ms = state_names(aggs), math.gcd(size_ms, slide_ms)
    panes = _panes(df, keys, ts, pane_ms, aggs)
    # Windows start at multiples of the slide: the last one that holds the pane, and those before it that still reach it.
    width, step = F.lit(size_ms * 1000), F.lit(slide_ms * 1000)
    last = micros("_pane") - F.pmod(micros("_pane"), step)
    first = last - F.floor((width - F.lit(pane_ms * 1000) - F.pmod(micros("_pane"), step)) / step) * step
    starts = F.when(first <= last, F.sequence(first.cast("bigint"), last, step.cast("bigint")))
    copies = panes.select("*", F.explode(starts).alias("_start")).select(
        *keys,
        F.timestamp_micros("_start").alias("window_start"),
        *names,
    )
    return _finished(merged(copies, [*keys, "window_start"], aggs), keys, size_ms, aggs)


def window_content(
    df: DataFrame, keys: Sequence[str], ts: str, size_ms: int, order: Sequence[str], split: Split | None = None
) -> DataFrame:
    """Rows of each window numbered by ``ts``, arrival breaking ties: the sorted content as rows, not as one array per window."""
    start = window_start(ts, size_ms)
    rows = df.where(F.col(ts).isNotNull()).withColumn("window_start", start)
    return scan(rows, [*keys, "window_start"], [ts, *order], [count_rows("position")], split=split)


def concat_in_order(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    col: str,
    sep: str = "",
    name: str | None = None,
    aggs: Sequence[Agg] = (),
    split: Split | None = None,
) -> DataFrame:
    """Strings of a group joined in arrival order, with further aggregates beside it.

    The joined string is one value per group by definition.  Hot groups (``split``) are joined per arrival
    range first, so that sorting and buffering of their rows is spread and the last step only joins the pieces.
    """
    name = name or f"concat_{col}"
    text = joined(col, order, sep, name)
    parts = [text, *aggs]
    if split is None:
        out = merged(df.select(*groups, *state_columns(parts)), groups, parts)
        return out.select(*groups, *final_columns(parts))
    # Rows without a value are skipped by a join, so a range without any must not add a separator.
    rows = split.assign(df.select(*dict.fromkeys([*groups, *split.keys, *order]), F.col(col).alias("_v"), *state_columns(aggs)))
    first = joined("_v", order, sep, "_piece")
    pieces = rows.groupBy(*groups, BUCKET).agg(
        *[e.alias(first.state[s]) for s, e in _raw_merge(first).items()],
        F.count("_v").alias("_count"),
        *[e.alias(a.state[s]) for a in aggs for s, e in a.merge(a.state).items()],
    ).withColumn("_piece", F.when(F.col("_count") > 0, first.final(first.state)))
    second = joined("_piece", [BUCKET], sep, name)
    ready = pieces.select(*groups, *state_columns([second]), *state_names(aggs))
    out = merged(ready, groups, [second, *aggs])
    return out.select(*groups, *final_columns([second, *aggs]))


def _raw_merge(agg: Agg) -> dict[str, Column]:
    """Merge straight from rows, where the state columns were not projected before."""
    return {s: F.flatten(F.collect_list(c)) for s, c in agg.row.items()}
