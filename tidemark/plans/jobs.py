"""Jobs from text lines to results.  Input, output and window sizes are arguments; nothing is read from a fixed place.

Every job is a function of DataFrames, so the caller chooses source and sink (``tidemark.sources``).  ``arrival`` names the
columns that order the lines; without them "first", "last" and "before" have no meaning on a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import parse as P
from tidemark.functions.aggregates import count_rows, first_by, greatest, last_by, least, total
from tidemark.functions.times import from_millis
from tidemark.operators.delta import delta_trigger_top
from tidemark.operators.joins import interval_join
from tidemark.operators.scan import plan_split
from tidemark.operators.watermark import firing_log, late_rows, watermark_column
from tidemark.operators.windows import COPIES, concat_in_order, sliding, tumbling, window_start
from tidemark.sources.staging import staged


def _timed(lines: DataFrame, parser: P.LineParser, mode: str) -> DataFrame:
    return P.parse(lines, parser, mode).rows.withColumn("ts", from_millis("ts_ms"))


def car_windows(
    lines: DataFrame, size_ms: int = 3000, parser: P.LineParser = P.CAR_TEXT, mode: str = "fail"
) -> DataFrame:
    """Final result per car kind and window: count, time range by time, sum."""
    aggs = [count_rows("n"), least("ts", "first_ts"), greatest("ts", "last_ts"), total("car_sum", "total")]
    return tumbling(_timed(lines, parser, mode), ["car_kind"], "ts", size_ms, aggs)


def car_windows_by_arrival(
    lines: DataFrame, arrival: Sequence[str], size_ms: int = 3000, parser: P.LineParser = P.CAR_JSON_LINE, mode: str = "fail"
) -> DataFrame:
    """The same with the time range taken from the first and last arrival."""
    aggs = [count_rows("n"), first_by("ts", arrival, "first_ts"), last_by("ts", arrival, "last_ts"), total("car_sum", "total")]
    return tumbling(_timed(lines, parser, mode), ["car_kind"], "ts", size_ms, aggs)


def car_firings(
    lines: DataFrame,
    arrival: Sequence[str],
    size_ms: int = 3000,
    delay_ms: int = 3500,
    lateness_ms: int = 5000,
    by_arrival: bool = False,
    parser: P.LineParser = P.CAR_TEXT,
    mode: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Every firing of the car windows under disorder and allowed lateness, and the rows that came too late.

    The time range goes from the earliest to the latest time, or from the first to the last arrival.
    """
    rows = staged(_timed(lines, parser, mode))
    marked = watermark_column(rows, "ts", arrival, delay_ms, plan_split(rows, [], arrival))
    ends = [first_by("ts", arrival, "first_ts"), last_by("ts", arrival, "last_ts")]
    if not by_arrival:
        ends = [least("ts", "first_ts"), greatest("ts", "last_ts")]
    aggs = [count_rows("n"), *ends, total("car_sum", "total")]
    split = plan_split(rows, ["car_kind"], arrival)
    log = firing_log(marked, ["car_kind"], "ts", arrival, size_ms, aggs, lateness_ms, split=split)
    return log, late_rows(marked, "ts", size_ms, lateness_ms)


def car_late(
    lines: DataFrame,
    arrival: Sequence[str],
    size_ms: int = 3000,
    delay_ms: int = 3500,
    lateness_ms: int = 5000,
    parser: P.LineParser = P.CAR_TEXT,
    mode: str = "fail",
) -> DataFrame:
    """The rows that come too late for the car windows, without planning the log of ``car_firings``."""
    rows = staged(_timed(lines, parser, mode))
    marked = watermark_column(rows, "ts", arrival, delay_ms, plan_split(rows, [], arrival))
    return late_rows(marked, "ts", size_ms, lateness_ms)


def keyed_windows(lines: DataFrame, size_ms: int = 3000, mode: str = "fail") -> DataFrame:
    """Count, earliest and latest time per key and window."""
    aggs = [count_rows("n"), least("ts", "first_ts"), greatest("ts", "last_ts")]
    return tumbling(_timed(lines, P.KEYED, mode), ["key"], "ts", size_ms, aggs)


def car_sliding(
    lines: DataFrame, size_ms: int = 10_000, slide_ms: int = 5000, parser: P.LineParser = P.CAR_JSON_LINE, mode: str = "fail",
    overlap: str = COPIES,
) -> DataFrame:
    """Sum and row count per car kind and sliding window."""
    aggs = [total("car_sum", "total"), count_rows("n")]
    return sliding(_timed(lines, parser, mode), ["car_kind"], "ts", size_ms, slide_ms, aggs, overlap)


def counted_messages(lines: DataFrame, arrival: Sequence[str], size_ms: int = 10_000) -> DataFrame:
    """Sum of counts per key and window, with the times joined by a bar in arrival order.  Malformed lines are skipped."""
    rows = staged(_timed(lines, P.COUNTED, "drop")).withColumn("window_start", window_start("ts", size_ms))
    split = plan_split(rows, ["key"], arrival)
    return concat_in_order(
        rows, ["key", "window_start"], arrival, "time", "|", "times", [total("n", "total")], split
    )


def top_speed(
    lines: DataFrame, arrival: Sequence[str], threshold: float = 50, evict_ms: int = 10_000, mode: str = "fail"
) -> DataFrame:
    """Top speed of each car over the last stretch of time, whenever it has gone another ``threshold`` metres."""
    rows = staged(_timed(lines, P.TELEMETRY, mode))
    split = plan_split(rows, ["id"], arrival)
    time_split = plan_split(rows, ["id"], ["ts", *arrival]) if split else None
    fields = ["id", "speed", "distance", "ts_ms"]
    return delta_trigger_top(
        rows, ["id"], arrival, "ts", "distance", "speed", threshold, evict_ms, fields, split, time_split
    )


def people_with_jobs(people: DataFrame, jobs: DataFrame, time: str, band_ms: int = 1000, mode: str = "drop") -> DataFrame:
    """People and jobs of the same name seen within a band of time; ``shiptime`` is the time of the job line."""
    left = P.parse(people, P.PERSON, mode).rows
    right = P.parse(jobs, P.JOB, mode).rows
    both = interval_join(left, right, ["name"], time, time, band_ms, band_ms)
    return both.select(
        F.col("l_name").alias("name"), F.col("l_age").alias("age"), F.col("l_sexy").alias("sexy"),
        F.col("r_job").alias("job"), F.col(f"r_{time}").alias("shiptime"),
    )


def bytes_per_user(edits: DataFrame, ingest: str, size_ms: int = 5000) -> DataFrame:
    """Changed bytes per user and window of the ingest time."""
    return tumbling(edits, ["user"], ingest, size_ms, [total("byte_diff", "bytes")])
