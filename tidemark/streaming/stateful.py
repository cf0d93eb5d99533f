"""Count windows and delta triggers on streams: custom state per key.

Rows of one micro-batch reach a key in no fixed order, so the processors sort them by the order columns first.  State is
bounded: at most ``n`` rows for a count window; for a delta trigger one mark and those rows younger than the eviction time that
have a greater rank than all after them.
A key's share of a micro-batch is held in memory, so bound micro-batches at the source (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``).  RocksDB must be the state store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _in_order(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(list(order), kind="stable")


class CountWindows(StatefulProcessor):
    """After every ``slide`` rows of a key, the last ``n`` values joined in order, nulls left out; tumbling windows when slide = n."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], n: int, slide: int, sep: str):
        self.keys, self.order, self.n, self.slide, self.sep = list(keys), list(order), n, slide, sep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n bigint")
        self.tail = handle.getListState("tail", "v string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        values = [v for (v,) in self.tail.get()] if self.tail.exists() else []
        before = self.seen.get()[0] if self.seen.exists() else 0
        offset = before - len(values)
        values += _in_order(rows, self.order)["row_value"].tolist()
        after = offset + len(values)
        fires = range((before // self.slide + 1) * self.slide, after + 1, self.slide)
        texts = [self.sep.join(v for v in values[max(0, end - self.n - offset): end - offset] if isinstance(v, str)) for end in fires]
        self.seen.update((after,))
        self.tail.put([(v,) for v in values[-self.n:]])
        if texts:
            head = {k: [part] * len(texts) for k, part in zip(self.keys, key)}
            yield pd.DataFrame({**head, "window_no": [end // self.slide for end in fires], "joined": texts})

    def close(self) -> None:
        pass


class DeltaTop(StatefulProcessor):
    """Fires when the measure is more than ``threshold`` above the mark; reports the top row younger than the eviction time.

    The candidates for the top are a deque: each has a greater rank than all that came after it, so a new row drives out the
    lower ones at the end, and old ones leave at the front.  It is kept as numbered entries of a map with the numbers of its
    ends, so a micro-batch reads and writes only the entries that come or go.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], threshold: float, evict_us: int, kinds: tuple[str, str]):
        self.keys, self.order, self.threshold, self.evict_us, self.kinds = list(keys), list(order), threshold, evict_us, kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        measure, rank = self.kinds
        self.mark = handle.getValueState("mark", f"value {measure}")
        self.ends = handle.getValueState("ends", "front bigint, back bigint, newest bigint")
        self.entries = handle.getMapState("entries", "at bigint", f"us bigint, rank {rank}, content string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = self.mark.get()[0] if self.mark.exists() else None
        front, back, newest = self.ends.get() if self.ends.exists() else (0, 0, None)
        kept, known, out = range(front, back), {}, []

        def entry(at: int):
            if at not in known:
                known[at] = tuple(self.entries.getValue((at,)))
            return known[at]

        changed = set()
        rows = _in_order(rows, self.order)
        names = ["row_us", "row_measure", "row_rank", "row_ranked", "row_content"]
        for us, measure, rank, ranked, content in zip(*(rows[c].tolist() for c in names)):
            newest = us if newest is None else max(newest, us)
            if ranked:
                # The first of equal ranks wins.
                while back > front and entry(back - 1)[1] < rank:
                    back -= 1
                known[back] = (us, rank, content)
                changed.add(back)
                back += 1
            while back > front and entry(front)[0] <= newest - self.evict_us:
                front += 1
            if mark is None:
                mark = measure
            elif measure - mark > self.threshold:
                mark = measure
                out.append((*key, us, content, entry(front)[2] if back > front else None))
        for at in kept:
            if at < front or at >= back:
                self.entries.removeKey((at,))
        for at in changed:
            if front <= at < back:
                self.entries.updateValue((at,), known[at])
        self.mark.update((mark,))
        self.ends.update((front, back, newest))
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, "fire_us", "fired", "top"])

    def close(self) -> None:
        pass


def _keys(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def count_windows_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, slide: int | None = None, sep: str = ""
) -> DataFrame:
    """Keys, ``window_no`` and the values of the window ``joined`` in arrival order; an incomplete tumbling window gives no row."""
    # Spark hands frames over as named tuples, which do not keep names with a leading underscore.
    rows = df.select(*keys, *order, F.col(value).cast("string").alias("row_value"))
    schema = T.StructType([
        *_keys(df, keys), T.StructField("window_no", T.LongType()), T.StructField("joined", T.StringType())
    ])
    processor = CountWindows(keys, order, n, slide or n, sep)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "None")


JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def delta_top_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, measure: str, by: str, threshold: float, evict_ms: int,
    fields: Sequence[str],
) -> DataFrame:
    """The delta trigger as a stream, with the columns of the table form: keys, order columns, ``fire_ts``, and ``top``, ``fields`` of
    the row with the greatest ``by`` (the first on ties) among rows that arrived up to the firing and are less than
    ``evict_ms`` older than it.

    Rows without time or measure are left out; rows without ``by`` can fire but not be the top.  Times must not decrease in
    arrival order within a key.  Whole numbers are compared as such, other measures and ranks as doubles.  Contents travel through
    the state as JSON, so ``fields`` may have any type that JSON keeps.
    """
    def number(name: str) -> tuple[str, Column]:
        kind = "bigint" if isinstance(df.schema[name].dataType, T.IntegralType) else "double"
        return kind, F.col(name).cast(kind)

    (measured, value), (ranked, rank) = number(measure), number(by)
    content = list(dict.fromkeys([*order, *fields]))
    usable = value.isNotNull() & F.col(ts).isNotNull() & ~F.isnan(value.cast("double"))
    rows = df.where(usable).select(
        *keys, *order, F.unix_micros(ts).alias("row_us"), value.alias("row_measure"),
        F.coalesce(rank, F.lit(0).cast(ranked)).alias("row_rank"), rank.isNotNull().alias("row_ranked"),
        F.to_json(F.struct(*content), JSON).alias("row_content"),
    )
    schema = T.StructType([
        *_keys(df, keys), T.StructField("fire_us", T.LongType()), T.StructField("fired", T.StringType()), T.StructField("top", T.StringType())
    ])
    processor = DeltaTop(keys, order, threshold, evict_ms * 1000, (measured, ranked))
    fired = rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "None")
    whole = T.StructType([df.schema[c] for c in content])
    fired = fired.withColumns({c: F.from_json(c, whole, JSON) for c in ("fired", "top")})
    return fired.select(
        *keys, *[F.col(f"fired.{c}").alias(c) for c in order], F.timestamp_micros("fire_us").alias("fire_ts"),
        F.when(F.col("top").isNotNull(), F.struct(*[F.col(f"top.{c}").alias(c) for c in fields])).alias("top"),
    )
