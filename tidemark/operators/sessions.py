"""Session windows on tables.  (Streams use ``F.session_window``, see ``tidemark.streaming.windows``.)

``F.session_window`` brings a whole key into one task.  Here a key that is too hot is cut into time ranges:
sessions are found inside each range, and only the first and last session of a range can continue in a
neighbour, so only these few are merged per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import (
    Agg, final_columns, greatest, least, merged, state_columns, state_names,
)
from tidemark.functions.times import micros
from tidemark.operators.scan import BUCKET, Split


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_ms: int,
    aggs: Sequence[Agg],
    split: Split | None = None,
) -> DataFrame:
    """Aggregates per key and session.  Rows up to and including ``gap_ms`` apart share a session.

    ``window_end`` is the last time plus the gap.  ``split`` comes from ``plan_split(df, keys, [ts, ...])``.  With hot times (many
    rows of one key at one instant) it also pre-aggregates equal times, which cannot change any session.
    """
    gap = F.lit(gap_ms * 1000)
    span = [least("_us", "_from"), greatest("_us", "_to")]
    parts = [*span, *aggs]
    begin, end = (a.state[""] for a in span)
    rows = df.where(F.col(ts).isNotNull())
    if split is None:
        rows = rows.withColumn(BUCKET, F.lit(0).cast("bigint"))
    else:
        # The range depends on the time alone: equal times must stay together.
        rows = split.by_first_column().assign(rows)
    timed = rows.withColumn("_us", micros(ts)).select(*keys, BUCKET, "_us", *state_columns(parts))
    if split is not None and split.heavy:
        timed = merged(timed, [*keys, BUCKET, "_us"], parts)

    here = Window.partitionBy(*keys, BUCKET).orderBy("_us")
    previous = F.lag("_us").over(here)
    opened = timed.withColumn("_open", F.coalesce((F.col("_us") - previous > gap).cast("int"), F.lit(1)))
    numbered = opened.withColumn("_no", F.sum("_open").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    partial = merged(numbered, [*keys, BUCKET, "_no"], parts)
    done = partial
    if split is not None:
        span_of_range = Window.partitionBy(*keys, BUCKET)
        partial = partial.withColumn("_last", F.max("_no").over(span_of_range))
        edge = (F.col(BUCKET) > 0) & ((F.col("_no") == 1) | (F.col("_no") == F.col("_last")))
        across = Window.partitionBy(*keys).orderBy(BUCKET, "_no")
        edges = partial.where(edge).withColumn(
            "_open", F.coalesce((F.col(begin) - F.lag(end).over(across) > gap).cast("int"), F.lit(1))
        ).withColumn("_no", F.sum("_open").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        names = state_names(parts)
        stitched = merged(edges, [*keys, "_no"], parts).select(*keys, *names)
        done = partial.where(~edge).select(*keys, *names).unionByName(stitched)
    return done.select(
        *keys,
        F.timestamp_micros(begin).alias("window_start"),
        F.timestamp_micros(F.col(end) + gap).alias("window_end"),
        *final_columns(aggs),
    )
