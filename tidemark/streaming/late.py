"""Windows of a stream with a complete late-row output.

Built-in windowed aggregation drops late rows silently, so the split is made in ``foreachBatch``, before any aggregation.  The
watermark moves between micro-batches.

State is a log.  Keys are dealt into buckets.  A micro-batch appends, to each bucket it has rows for, the partial
aggregates of its own rows; states merge, so nothing older is read or written for that.  A bucket is read when one of its
windows fires, and compacted into one table when it has gathered some entries, leaving out windows that are over.  So a batch that
touches one bucket writes one, and a bucket that nothing happens to is not looked at.

Everything is written under the id of the batch, and a batch reads what the one before left: its watermark and, per bucket, the
live entries and the window ends still to come.  So a rerun after a failure overwrites and repeats exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import Agg, final_columns, merges, state_columns, state_names
from tidemark.functions.times import micros, ms
from tidemark.operators.watermark import WATERMARK, is_late, is_passed

BUCKETS = 64
ENTRIES = 8


@dataclass(frozen=True)
class Bucket:
    """The live entries of a bucket (batch ids of its last compaction, if any, and of the appends since) and the ends, in
    microseconds, of its windows that have not fired yet."""

    base: int | None
    appends: tuple[int, ...]
    ends: frozenset[int]


class LateSplit:
    """Batch function for ``writeStream.foreachBatch``.

    Under ``path`` it writes, per batch id, ``results`` (windows that fired: at closing, and again for each batch that changed
    them within the lateness, ``again`` = true) and ``late`` (rows no window takes any more).  ``path`` must be on storage
    all executors and a restarted driver can reach.  The driver holds, per bucket, the distinct ends of open windows, which keys
    share, and no states.
    """

    def __init__(
        self, path: str, keys: Sequence[str], ts: str, size_ms: int, aggs: Sequence[Agg], delay_ms: int,
        lateness_ms: int = 0, slide_ms: int | None = None, buckets: int = BUCKETS, entries: int = ENTRIES,
    ):
        self.path, self.keys, self.ts, self.size_ms, self.aggs = path.rstrip("/"), list(keys), ts, size_ms, list(aggs)
        self.delay_ms, self.lateness_ms, self.slide_ms = delay_ms, lateness_ms, slide_ms or size_ms
        self.buckets, self.entries = buckets, entries

    def _dir(self, kind: str, batch_id: int, bucket: int | None = None) -> str:
        return f"{self.path}/{kind}/batch={batch_id}" + ("" if bucket is None else f"/bucket={bucket}")

    def _refuse_old(self, spark: SparkSession) -> None:
        """A path that holds later batches belongs to another run; its results would be read as this one's."""
        place = spark._jvm.org.apache.hadoop.fs.Path(self._dir("state", 1))
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            raise ValueError(f"{self.path} holds the batches of an earlier run")

    def _state(self, spark: SparkSession, batch_id: int) -> tuple[int | None, dict[int, Bucket]]:
        """Greatest time seen, and the buckets, after a batch."""
        if batch_id < 0:
            return None, {}
        high, log = None, {}
        for r in spark.read.parquet(self._dir("state", batch_id)).collect():
            if r["bucket"] < 0:
                high = r["high"]
            else:
                log[r["bucket"]] = Bucket(r["base"], tuple(r["appends"]), frozenset(r["ends"]))
        return high, log

    def _put_state(self, spark: SparkSession, batch_id: int, high: int | None, log: dict[int, Bucket]) -> None:
        rows = [(-1, high, None, [], [])] + [(b, None, s.base, list(s.appends), sorted(s.ends)) for b, s in log.items()]
        schema = "bucket int, high bigint, base bigint, appends array<bigint>, ends array<bigint>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(self._dir("state", batch_id))

    def _mark(self, high: int | None) -> Column:
        return F.timestamp_micros(F.lit(self._mark_us(high)).cast("bigint"))

    def _mark_us(self, high: int | None) -> int | None:
        return None if high is None else high - self.delay_ms * 1000

    def _end(self) -> Column:
        return micros("window_start") + F.lit(self.size_ms * 1000)

    def _passed(self, high: int | None, lateness_ms: int = 0) -> Column:
        """Has the watermark that follows ``high`` passed the window of a row?"""
        us = self._mark_us(high)
        return F.lit(False) if us is None else F.lit(us) >= self._end() + F.lit((lateness_ms - 1) * 1000)

    def _any_passed(self, ends: Iterable[int], high: int | None) -> bool:
        us = self._mark_us(high)
        return us is not None and any(us >= end - 1000 for end in ends)

    def _read(self, spark: SparkSession, schema: T.StructType, buckets: dict[int, Bucket]) -> DataFrame:
        """The states in the live entries of some buckets."""
        paths = [self._dir("base", s.base, b) for b, s in buckets.items() if s.base is not None]
        paths += [self._dir("appends", batch_id, b) for b, s in buckets.items() for batch_id in s.appends]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            self._refuse_old(spark)
        rows = batch.where(F.col(self.ts).isNotNull()).persist()
        try:
            before, log = self._state(spark, batch_id - 1)
            newest = rows.agg(F.max(micros(self.ts))).first()[0]
            high = max((h for h in (before, newest) if h is not None), default=None)
            marked = rows.withColumn(WATERMARK, self._mark(before))
            late = is_late(self.ts, self.size_ms, self.lateness_ms, self.slide_ms)
            marked.where(late).drop(WATERMARK).write.mode("overwrite").parquet(self._dir("late", batch_id))
            added = self._added(marked)
            added.write.mode("overwrite").partitionBy("bucket").parquet(self._dir("appends", batch_id))
        finally:
            rows.unpersist()
        schema = T.StructType([f for f in added.schema if f.name != "bucket"])
        added = spark.read.schema(added.schema).parquet(self._dir("appends", batch_id))
        touched = {r["bucket"]: r["ends"] for r in added.groupBy("bucket").agg(F.collect_set(self._end()).alias("ends")).collect()}

        self._fired(spark, schema, batch_id, before, high, log, touched).write.mode("overwrite").parquet(self._dir("results", batch_id))
        after = {b: Bucket(s.base, s.appends + (batch_id,) * (b in touched), s.ends | {*touched.get(b, ())})
                 for b, s in {**{b: Bucket(None, (), frozenset()) for b in touched}, **log}.items()}
        full = {b: s for b, s in after.items() if len(s.appends) >= self.entries}
        if full:
            self._compact(spark, schema, batch_id, high, full)
        after = {b: Bucket(batch_id if b in full else s.base, () if b in full else s.appends,
                           frozenset(e for e in s.ends if not self._any_passed([e], high))) for b, s in after.items()}
        self._put_state(spark, batch_id, high, after)
        self._forget(spark, batch_id, log, after)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _added(self, marked: DataFrame) -> DataFrame:
        """Partial aggregates of the rows of a batch, for the windows that still take them."""
        rows = marked.select(
            *self.keys, F.window(self.ts, ms(self.size_ms), ms(self.slide_ms)).alias("_w"), WATERMARK, *state_columns(self.aggs)
        ).withColumn("window_start", F.col("_w.start"))
        return self._merged(rows.where(~is_passed(self._end(), self.lateness_ms))).withColumn("bucket", self._bucket())

    def _merged(self, states: DataFrame, *more: Column) -> DataFrame:
        return states.groupBy(*self.keys, "window_start").agg(*[e.alias(n) for n, e in merges(self.aggs)], *more)

    def _fired(
        self, spark: SparkSession, schema: T.StructType, batch_id: int, before: int | None, high: int | None,
        log: dict[int, Bucket], touched: dict[int, list[int]],
    ) -> DataFrame:
        """Windows that close now, and closed ones that this batch changed; only their buckets are read."""
        ready = {b for b, s in log.items() if self._any_passed(s.ends, high)}
        ready |= {b for b, ends in touched.items() if self._any_passed(ends, high)}
        old = self._read(spark, schema, {b: s for b, s in log.items() if b in ready}).withColumn("_new", F.lit(False))
        new = self._read(spark, schema, {b: Bucket(None, (batch_id,), frozenset()) for b in touched if b in ready})
        closed, already = self._passed(high), self._passed(before)
        # Before the merge, so that only the row groups of these windows are read.
        both = old.unionByName(new.withColumn("_new", F.lit(True))).where(closed)
        windows = self._merged(both, F.max("_new").alias("_changed"), F.min("_new").alias("_first"))
        return self._results(windows.where(F.col("_changed") | ~already), ~F.col("_first") & already)

    def _compact(self, spark: SparkSession, schema: T.StructType, batch_id: int, high: int | None, full: dict[int, Bucket]) -> None:
        """One table in place of a bucket's entries, without the windows that take no more rows."""
        live = self._read(spark, schema, full).where(~self._passed(high, self.lateness_ms))
        whole = self._merged(live).withColumn("bucket", self._bucket())
        whole.write.mode("overwrite").partitionBy("bucket").parquet(self._dir("base", batch_id))
        made = {r[0] for r in whole.sparkSession.read.schema(whole.schema).parquet(self._dir("base", batch_id)).select("bucket").distinct().collect()}
        for b in full.keys() - made:  # nothing is open; the entry is there all the same
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(self._dir("base", batch_id, b))

    def _results(self, windows: DataFrame, again: Column) -> DataFrame:
        return windows.select(
            *self.keys, "window_start", F.timestamp_micros(self._end()).alias("window_end"), *final_columns(self.aggs), again.alias("again")
        )

    def flush(self, spark: SparkSession, last_batch_id: int) -> DataFrame:
        """Results of the windows still waiting for their first firing when the input ended."""
        high, log = self._state(spark, last_batch_id)
        waiting = {b: s for b, s in log.items() if s.ends}
        path = next((self._dir("appends", i, b) if i is not None else self._dir("base", s.base, b)
                     for b, s in waiting.items() for i in (*s.appends, None)), None)
        if path is None:
            return spark.read.parquet(self._dir("results", last_batch_id)).limit(0)
        live = self._read(spark, spark.read.parquet(path).schema, waiting)
        return self._results(self._merged(live.where(~self._passed(high))), F.lit(False))

    def _forget(self, spark: SparkSession, batch_id: int, log: dict[int, Bucket], after: dict[int, Bucket]) -> None:
        """Delete what neither this batch's state nor the one before, which a rerun would read, refers to."""
        def places(state: dict[int, Bucket]) -> set[str]:
            found = {self._dir("base", s.base, b) for b, s in state.items() if s.base is not None}
            return found | {self._dir("appends", i, b) for b, s in state.items() for i in s.appends}

        place = spark._jvm.org.apache.hadoop.fs.Path(self._dir("state", batch_id - 2))
        if batch_id < 2 or not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return  # nothing older, or this is a rerun
        _, oldest = self._state(spark, batch_id - 2)
        gone = places(oldest) - places(log) - places(after)
        for path in [*gone, self._dir("state", batch_id - 2)]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
