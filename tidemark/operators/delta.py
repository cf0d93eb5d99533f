"""Delta-triggered windows: per key, fire when a measure has grown by more than a threshold since the last firing,
and report the top row of the last stretch of time.

Three facts keep this parallel.

* A row can only fire if it exceeds every earlier row of its key: the earlier ones since the last firing stayed within
  the threshold of the mark.  So only running maxima matter, and they increase strictly.
* From a mark, the next firing is the first running maximum far enough above it: a binary search.  What one arrival range of a
  key does to a mark is a short step function (mark in, mark out), found without knowing the mark.  For a hot
  key the functions of neighbouring ranges are composed, those of neighbouring blocks again, and so on: a tree.  Down the
  tree every block and in the end every range gets the mark it starts with, then all ranges fire in parallel.
* Time is cut into blocks of the eviction length.  The window of a firing is a tail of the previous block and a head of its own,
  so both are running maxima, and no row is copied into every window that contains it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import greatest, top_row
from tidemark.functions.times import micros
from tidemark.operators.scan import BUCKET, Split, scan
from tidemark.sources.staging import staged


# Kinds of rows that meet in the search for the top of a window.
ROW, HEAD, TAIL = 0, 1, 2
# So many neighbours are composed into a block.
FAN = 16
# So many rows go to a task that sorts them (it holds them several times); the session setting overrides the number.
TASK_ROWS = 100_000
TASK_ROWS_SETTING = "spark.tidemark.taskRows"


def _next(values: np.ndarray, marks: np.ndarray, threshold) -> np.ndarray:
    """For each mark, position of the first of the increasing ``values`` with ``value - mark > threshold``."""
    if values.dtype == np.int64:
        largest = np.iinfo(np.int64).max
        return np.searchsorted(values, np.where(marks > largest - threshold, largest, marks + threshold), "right")
    at = np.searchsorted(values, marks + threshold, "right")
    if values.dtype == object:  # decimals are exact
        return at
    # mark + threshold is rounded; settle the border on the exact comparison.
    while True:
        back = (at > 0) & (values[np.maximum(at - 1, 0)] - marks > threshold)
        ahead = (at < len(values)) & (values[np.minimum(at, len(values) - 1)] - marks <= threshold)
        if not (back.any() or ahead.any()):
            return at
        at = at - back + ahead


def _fire(threshold):
    """Keep the firing rows of a partition sorted by group and value.  Only the mark passes from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = None
        for batch in batches:
            values = batch.column("_value").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(batch.column("_first").to_numpy(zero_copy_only=False))
            hits: list[int] = []
            for lo, hi in zip([0, *starts], [*starts, len(values)]):
                if lo == hi:
                    continue
                if lo in starts[:1] or lo > 0:
                    mark = values[lo]
                part = values[lo:hi]
                i = int(_next(part, np.array([mark], values.dtype), threshold)[0])
                following = _next(part, part, threshold).tolist()
                while i < len(part):
                    mark = part[i]
                    hits.append(lo + i)
                    i = following[i]
            yield batch.take(pa.array(hits, pa.int64())).drop_columns(["_first", "_seed"])

    return run


def _step_function(threshold):
    """Mark in, mark out of one arrival range: the first row (_upto, _exit) with ``_upto - mark > threshold`` gives the mark out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["_value"].to_numpy())
        n = len(values)
        after = _next(values, values, threshold)
        last = np.where(after < n, after, np.arange(n))
        while (further := last[last]).tolist() != last.tolist():
            last = further
        # A mark lies below the first value of the range, so it fires at one of these rows or not at all.
        reach = min(n, int(after[0]) + 1)
        return _pieces(pdf.drop(columns=["_value"]), values[0], values[:reach], values[last[:reach]])

    return run


def _pieces(keys: pd.DataFrame, least, upto: np.ndarray, leave: np.ndarray) -> pd.DataFrame:
    """A step function as rows, one for each run of equal marks out; ``_least`` is the first value of its rows."""
    ends = np.append(np.flatnonzero(leave[1:] != leave[:-1]), len(leave) - 1)
    rows = keys.iloc[[0] * len(ends)].reset_index(drop=True)
    return rows.assign(_least=least, _upto=upto[ends], _exit=leave[ends])


def _children(pdf: pd.DataFrame):
    """The functions of a block in order: number, first value, and the steps."""
    for node, own in pdf.sort_values(["_node", "_upto"]).groupby("_node", sort=True):
        yield node, own["_least"].iloc[0], own["_upto"].to_numpy(), own["_exit"].to_numpy()


def _passed(marks: np.ndarray, upto: np.ndarray, leave: np.ndarray, threshold) -> np.ndarray:
    """Marks out of a function: marks that it never fires for stay."""
    at = _next(upto, marks, threshold)
    return np.where(at < len(upto), leave[np.minimum(at, len(upto) - 1)], marks)


def _compose(threshold):
    """One function for the neighbours of a block: what leaves one enters the next."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        upto = leave = least = None
        for _, first, ups, outs in _children(pdf):
            if upto is None:
                least, upto, leave = first, ups, outs
                continue
            leave = _passed(leave, ups, outs, threshold)
            # Unless every mark (all lie below the block) has fired by now, the steps of the next range follow.
            if not upto[-1] - least > threshold:
                upto, leave = np.append(upto, ups), np.append(leave, outs)
        keys = pdf.drop(columns=["_node", "_least", "_upto", "_exit"]).rename(columns={"_block": "_node"})
        return _pieces(keys, least, upto, leave)

    return run


def _descend(threshold):
    """The mark that enters each neighbour of a block, from the mark that enters the block (node -1; none: the key starts here)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        given = pdf["_node"] == -1
        mark = pdf.loc[given, "_exit"].to_numpy()[:1] if given.any() else None
        nodes, marks = [], []
        for node, _, ups, outs in _children(pdf[~given]):
            if mark is None:
                mark = outs[:1]
                continue
            nodes.append(int(node))
            marks.append(mark[0])
            mark = _passed(mark, ups, outs, threshold)
        rows = pdf.drop(columns=["_node", "_block", "_least", "_upto", "_exit"]).iloc[[0] * len(nodes)].reset_index(drop=True)
        return rows.assign(_node=np.array(nodes, np.int64), _entry=np.array(marks, pdf["_exit"].dtype))

    return run


def _schema_without(df: DataFrame, *names: str) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in names])


def _dealt(df: DataFrame, rows: int, keys: Sequence[str]) -> DataFrame:
    """``df`` dealt out by ``keys`` to as many tasks as ``rows`` rows need; small tables are left to Spark, which joins partitions."""
    spark = df.sparkSession
    tasks = math.ceil(rows / int(spark.conf.get(TASK_ROWS_SETTING, str(TASK_ROWS))))
    return df.repartition(tasks, *keys) if tasks > spark.sparkContext.defaultParallelism else df


def delta_fires(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measure: str,
    threshold: float,
    split: Split | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows that fire: the first row of a key sets the mark, then each row whose ``measure`` is more than ``threshold``
    above the mark fires and becomes the mark.  Returns keys, order columns, ``keep`` and ``measure``.

    Rows without a measure are passed over.  Hot keys are cut by ``split`` (``plan_split(df, keys, order)``).
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    columns = list(dict.fromkeys([*keys, *order, *keep]))
    value, limit, back = _exact(df, measure, threshold)
    rows = df.where(value.isNotNull()).select(*columns, value.alias("_value"))
    if split is None:
        rows = _dealt(rows, df.count(), keys)
    highs = scan(rows, keys, order, [greatest("_value", "_before")], inclusive=False, split=split)
    highs = highs.where(F.col("_before").isNull() | (F.col("_value") > F.col("_before"))).drop("_before")
    if split is None:
        marked = highs.withColumns({BUCKET: F.lit(0).cast("bigint"), "_seed": F.lit(False)})
    else:
        highs = staged(split.assign(highs))
        entries = _entry_marks(highs, keys, limit, split.ranges).withColumn("_seed", F.lit(True))
        marked = highs.withColumn("_seed", F.lit(False)).unionByName(entries, allowMissingColumns=True)
    # An entry mark comes from an earlier range, so it lies below the values of its own and sorts first.
    by_value = Window.partitionBy(*keys, BUCKET).orderBy("_value")
    ready = marked.withColumn("_first", F.row_number().over(by_value) == 1)
    # The window left the rows in this order, so it costs nothing to ask for it.
    ready = ready.sortWithinPartitions(*keys, BUCKET, "_value").drop(BUCKET)
    fired = ready.mapInArrow(_fire(limit), _schema_without(ready, "_first", "_seed"))
    return fired.select(*columns, back.alias(measure))


def _exact(df: DataFrame, measure: str, threshold: float) -> tuple[Column, object, Column]:
    """The measure as a number that is compared without rounding where its type allows: whole numbers and decimals of up to 18
    digits as 64-bit integers, other decimals as they are, all else as double without NaN.  With the threshold, and the way back."""
    kind, c, value = df.schema[measure].dataType, F.col(measure), F.col("_value")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        scale = Decimal(10) ** kind.scale
        return (c * F.lit(scale)).cast("bigint"), min(math.floor(Decimal(str(threshold)) * scale), 2**63 - 1), (value.cast("decimal(19,0)") / F.lit(scale)).cast(kind)
    if isinstance(kind, T.DecimalType):
        return c, Decimal(str(threshold)), value
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint"), min(math.floor(threshold), 2**63 - 1), value
    number = c.cast("double")
    return F.when(~F.isnan(number), number), float(threshold), value


def _entry_marks(highs: DataFrame, keys: Sequence[str], threshold, ranges: int) -> DataFrame:
    """Mark with which each range of a hot key starts, except the first range.

    ``ranges`` bounds the range numbers.  A task sees the functions of ``FAN`` neighbours, on the way up and down.
    """
    hot = highs.where(F.col(BUCKET) > 0).select(*keys, F.col(BUCKET).alias("_node"), "_value")
    names = _schema_without(hot, "_value", "_node").fields
    kind, node = hot.schema["_value"].dataType, T.StructField("_node", T.LongType())
    steps = T.StructType([*names, node, *[T.StructField(c, kind) for c in ("_least", "_upto", "_exit")]])
    entry = T.StructType([*names, node, T.StructField("_entry", kind)])
    levels = [staged(hot.groupBy(*keys, "_node").applyInPandas(_step_function(threshold), steps))]
    block = F.floor(F.col("_node") / FAN).alias("_block")
    highest = ranges
    while highest >= FAN:
        below = levels[-1].select("*", block)
        levels.append(staged(below.groupBy(*keys, "_block").applyInPandas(_compose(threshold), steps)))
        highest //= FAN
    entries = None
    for level in reversed(levels):
        rows = level.select("*", block)
        if entries is not None:
            mark = F.col("_entry")
            rows = rows.unionByName(entries.select(*keys, F.lit(-1).cast("bigint").alias("_node"), mark.alias("_least"), mark.alias("_upto"),
                                                   mark.alias("_exit"), F.col("_node").alias("_block")))
        entries = rows.groupBy(*keys, "_block").applyInPandas(_descend(threshold), entry)
    return entries.select(*keys, F.col("_node").alias(BUCKET), F.col("_entry").alias("_value"))


def delta_trigger_top(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ts: str,
    measure: str,
    by: str,
    threshold: float,
    evict_ms: int,
    fields: Sequence[str],
    split: Split | None = None,
    time_split: Split | None = None,
) -> DataFrame:
    """For each firing: keys, order columns, ``fire_ts``, and ``top``: ``fields`` of the row with the greatest ``by`` (the first
    on ties) among rows that arrived up to the firing and are less than ``evict_ms`` older than it.

    Times must not decrease in arrival order within a key, as telemetry promises (``ascending_violations`` finds offenders).
    ``time_split`` is ``plan_split(df, keys, [ts, *order])``; like ``split`` it is needed only when hot keys exist.
    """
    at = [f"_at_{c}" for c in order]
    fires = delta_fires(df, keys, order, measure, threshold, split, keep=[ts]).select(
        *keys, *[F.col(c).alias(a) for a, c in zip(at, order)], F.col(ts).alias("fire_ts")
    )
    if split is not None:
        fires = staged(fires)
    width = F.lit(evict_ms * 1000)
    content = list(dict.fromkeys([by, *order, *fields]))
    best = top_row(by, order, content)
    rows = df.select(*dict.fromkeys([*keys, *order, ts, *content])).withColumns(
        {"_block": F.floor(micros(ts) / width), "_probe": F.lit(ROW)}
    )
    # Each firing asks twice: for the head of its block up to the firing row, and for the tail of the block before, from
    # just after the eviction bound.
    own = F.floor(micros("fire_ts") / width)
    bound = F.timestamp_micros(micros("fire_ts") - width)
    questions = F.array(
        F.struct(own.alias("block"), F.col("fire_ts").alias("at"), F.lit(HEAD).alias("kind")),
        F.struct((own - 1).alias("block"), bound.alias("at"), F.lit(TAIL).alias("kind")),
    )
    probes = fires.withColumn("_q", F.explode(questions)).select(
        *keys, *at, "fire_ts", *[F.col(a).alias(c) for a, c in zip(at, order)],
        F.col("_q.at").alias(ts), F.col("_q.block").alias("_block"), F.col("_q.kind").alias("_probe"),
    )
    group = [*keys, "_block"]
    # Both scans share the grouping, so without hot keys they share one shuffle.
    asked = rows.unionByName(probes, allowMissingColumns=True)
    if split is None:
        asked = _dealt(asked, 3 * df.count(), group)  # every row may fire, and asks twice then
    heads = scan(asked, group, [*order, "_probe"], [best], split=split).withColumnRenamed("top", "_head")
    found = scan(heads, group, [ts, "_probe", *order], [best], True, True, time_split, totals_from=asked).where(
        F.col("_probe") != ROW
    ).withColumn("top", F.when(F.col("_probe") == HEAD, F.col("_head")).otherwise(F.col("top")))
    rank = F.struct(F.col(f"top.{by}"), *[(-F.col(f"top.{c}")).alias(f"o{i}") for i, c in enumerate(order)])
    winner = F.max_by("top", F.when(F.col(f"top.{by}").isNotNull(), rank))
    return found.groupBy(*keys, *at, "fire_ts").agg(winner.alias("top")).select(
        *keys, *[F.col(a).alias(c) for a, c in zip(at, order)], "fire_ts",
        F.struct(*[F.col(f"top.{c}").alias(c) for c in fields]).alias("top"),
    )
