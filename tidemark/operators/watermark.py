"""Event-time progress as data: the watermark each row met on arrival, the log of window firings, and late rows.

On a table the watermark is a column computed from the arrival order, so results are repeatable.  A row belongs to
a window with (exclusive) end ``e``.  With watermark ``wm`` and allowed lateness ``L`` the row is *on time* while
``wm < e - 1 ms``, makes the window fire *again* while ``wm < e - 1 ms + L``, and is *late* after that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.aggregates import (
    Agg, count_rows, final_columns, greatest, merged, state_columns, state_names, total,
)
from tidemark.functions.times import micros, ms
from tidemark.operators.scan import Split, scan
from tidemark.sources.staging import staged

WATERMARK = "watermark"
ON_TIME, AGAIN = "on_time", "again"


def watermark_column(
    df: DataFrame,
    ts: str,
    order: Sequence[str],
    delay_ms: int,
    split: Split | None,
    valid: Column | None = None,
    name: str = WATERMARK,
) -> DataFrame:
    """Watermark met by each row: greatest ``ts`` that arrived before it, minus ``delay_ms``; null before any.

    ``delay_ms`` is the bound on disorder; 0 gives a watermark that follows every row, 1 the explicit one a replayed
    source emits after each row.  Rows that are not ``valid`` do not move it.  The scan covers all rows in arrival order, so
    ``split`` (``plan_split(df, [], order)``) cuts it into arrival ranges.
    """
    seen = F.col(ts) if valid is None else F.when(valid, F.col(ts))
    high = scan(df.withColumn("_seen", micros(seen)), [], order, [greatest("_seen", "_high")], inclusive=False, split=split)
    return high.withColumn(name, F.timestamp_micros(F.col("_high") - F.lit(delay_ms * 1000))).drop("_seen", "_high")


def partitioned_watermark_column(
    df: DataFrame,
    ts: str,
    partition: str,
    partitions: Sequence,
    order: Sequence[str],
    delay_ms: int,
    split: Split | None,
    valid: Column | None = None,
    name: str = WATERMARK,
) -> DataFrame:
    """Watermark met by each row where every source partition has its own, and the least of them counts.

    ``partitions`` names the values of the column ``partition`` that are waited for, as a source's reader knows them.  Until each
    of them has sent a valid row there is no watermark.  Rows of other partitions (also null) do not move it.  One
    scan carries the greatest time of every partition; its state is one number per partition, whatever the rows.
    """
    valid = F.lit(True) if valid is None else valid
    if not partitions:
        raise ValueError("name the partitions to wait for")
    marks = [f"_high_{i}" for i in range(len(partitions))]
    seen = [F.when(valid & (F.col(partition) == F.lit(p)), micros(ts)).alias(f"_seen_{i}") for i, p in enumerate(partitions)]
    high = scan(df.select("*", *seen), [], order, [greatest(f"_seen_{i}", m) for i, m in enumerate(marks)], inclusive=False, split=split)
    low = F.array_min(F.array(*marks))
    all_seen = F.forall(F.array(*marks), lambda m: m.isNotNull())
    return high.withColumn(name, F.when(all_seen, F.timestamp_micros(low - F.lit(delay_ms * 1000)))).select(*df.columns, name)


def lag_watermark_column(df: DataFrame, ingest: str, lag_ms: int, name: str = WATERMARK) -> DataFrame:
    """Watermark that trails the ingest clock by a fixed lag."""
    return df.withColumn(name, F.timestamp_micros(micros(ingest) - F.lit(lag_ms * 1000)))


def ascending_violations(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], split: Split | None = None) -> DataFrame:
    """Rows whose time is before one already seen, i.e. that break the promise of ascending times."""
    high = scan(df, keys, order, [greatest(ts, "seen_ts")], inclusive=False, split=split)
    return high.where(F.col(ts) < F.col("seen_ts"))


def is_passed(end_us: Column, lateness_ms: int = 0, watermark: str = WATERMARK) -> Column:
    """Has the watermark passed the window end plus lateness?  A null watermark has passed nothing."""
    return F.coalesce(micros(watermark) >= end_us + F.lit((lateness_ms - 1) * 1000), F.lit(False))


def is_late(ts: str, size_ms: int, lateness_ms: int = 0, slide_ms: int | None = None, watermark: str = WATERMARK) -> Column:
    """True if every window of the row is closed: the newest one decides."""
    slide = (slide_ms or size_ms) * 1000
    newest_end = micros(ts) - F.pmod(micros(ts), F.lit(slide)) + F.lit(size_ms * 1000)
    return is_passed(newest_end, lateness_ms, watermark)


def behind_watermark(df: DataFrame, ts: str, watermark: str = WATERMARK) -> DataFrame:
    """Rows the watermark had already passed when they arrived, whatever window they belong to."""
    return df.where(F.col(ts) <= F.col(watermark))


def late_rows(
    df: DataFrame, ts: str, size_ms: int, lateness_ms: int = 0, slide_ms: int | None = None, watermark: str = WATERMARK
) -> DataFrame:
    """Side output: rows that no window takes any more.  ``df`` carries the watermark column."""
    return df.where(is_late(ts, size_ms, lateness_ms, slide_ms, watermark))


def firing_log(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    size_ms: int,
    aggs: Sequence[Agg],
    lateness_ms: int = 0,
    slide_ms: int | None = None,
    watermark: str = WATERMARK,
    split: Split | None = None,
) -> DataFrame:
    """Every result each window emits, in order (``firing`` from 1).

    The first result covers the on-time rows (``cause`` = ``on_time``); each later row within the lateness emits the
    window again with the content so far (``cause`` = ``again``, with the row's order columns).  The last result of
    a window is its final answer.  ``df`` carries the watermark column; input ends with a flush, so all windows fire.
    ``split`` cuts hot keys by arrival (``plan_split(df, keys, order)``); on-time rows only ever travel as partial aggregates.
    """
    names = state_names(aggs)
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.window(ts, ms(size_ms), ms(slide_ms or size_ms)).alias("_w"), watermark, *order, *state_columns(aggs)
    ).withColumn("window_start", F.col("_w.start"))
    end_us = micros(F.col("_w.end"))
    group = [*keys, "window_start"]
    fired = is_passed(end_us, 0, watermark)
    # One aggregation yields one row of all on-time rows (no order columns: null sorts first) and one row per later row.
    steps = merged(
        rows.where(~is_passed(end_us, lateness_ms, watermark)).select(
            *group, F.when(fired, F.lit(AGAIN)).otherwise(F.lit(ON_TIME)).alias("cause"),
            *[F.when(fired, F.col(c)).alias(c) for c in order], *names,
        ),
        [*group, "cause", *order], aggs,
    ).withColumnsRenamed({n: f"_in{n}" for n in names})
    if split is not None:
        steps = staged(steps)
    step = [_over_state(a) for a in aggs]
    log = scan(steps, group, order, [count_rows("firing"), *step], split=split)
    end = F.timestamp_micros(micros("window_start") + F.lit(size_ms * 1000))
    return log.select(
        *keys, "window_start", end.alias("window_end"), "firing", "cause", *order, *[a.name for a in aggs]
    )


def final_firings(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size_ms: int,
    aggs: Sequence[Agg],
    lateness_ms: int = 0,
    slide_ms: int | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    """The last result of each window of ``firing_log`` and its number, without the log: one aggregation of the rows that are
    not late.  A window fires once for its on-time rows, if it has any, and once for each later row."""
    end_us = micros(F.col("_w.end"))
    rows = df.where(F.col(ts).isNotNull()).withColumn("_w", F.window(ts, ms(size_ms), ms(slide_ms or size_ms)))
    rows = rows.where(~is_passed(end_us, lateness_ms, watermark))
    rows = rows.withColumn("_again", is_passed(end_us, 0, watermark).cast("bigint"))
    rows = rows.withColumns({"window_start": F.col("_w.start"), "_on_time": 1 - F.col("_again")})
    every = [total("_again", "_agains"), greatest("_on_time", "_any_on_time"), *aggs]
    group = [*keys, "window_start"]
    out = merged(rows.select(*group, *state_columns(every)), group, every).select(*group, *final_columns(every))
    end = F.timestamp_micros(micros("window_start") + F.lit(size_ms * 1000))
    firing = F.col("_agains") + F.col("_any_on_time")
    return out.select(*group, end.alias("window_end"), firing.alias("firing"), *[a.name for a in aggs])


def _over_state(agg: Agg) -> Agg:
    """The same aggregate over rows that already carry states."""
    return Agg(agg.name, {s: F.col(f"_in{c}") for s, c in agg.state.items()}, agg.merge, agg.final)
