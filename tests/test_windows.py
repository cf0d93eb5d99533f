"""Tumbling, sliding, session and delta windows, watermarks and late rows, against event-by-event Python."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.aggregates import count_rows, first_by, greatest, joined, last_by, least, top_row, total
from tidemark.functions.times import from_millis
from tidemark.operators import delta
from tidemark.operators.delta import delta_fires, delta_trigger_top
from tidemark.operators.joins import interval_join
from tidemark.operators.scan import plan_split
from tidemark.operators.sessions import sessions
from tidemark.operators.watermark import (
    ascending_violations, final_firings, firing_log, is_late, lag_watermark_column, late_rows, partitioned_watermark_column,
    watermark_column,
)
from tidemark.operators.windows import sliding, tumbling, window_content

F1 = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
M1 = [(0, 50, 0.0, 0), (0, 55, 20.0, 1000), (0, 60, 60.0, 2000), (0, 55, 100.0, 9000), (0, 50, 115.0, 12000), (0, 45, 170.0, 13000)]


def us(ts):
    return round(ts.timestamp() * 1000)


def stream(seed, n=500, spread=60_000, disorder=4000):
    """(key, ts ms, arr, v): a hot key, ties in time, rows out of order."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
        base = i * spread // n
        ts = max(0, base - rnd.randrange(disorder)) if disorder else base
        rows.append((key, ts, i, rnd.randrange(100)))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "key string, ms long, arr long, v long").repartition(4)
    return df.withColumn("ts", from_millis("ms"))


def test_tumbling_edges_and_nulls(spark):
    rows = [("a", 0, 1, 5), ("a", 2999, 2, 6), ("a", 3000, 3, 7), (None, 3001, 4, 8), ("a", None, 5, 9), ("a", -1, 6, 1)]
    aggs = [count_rows(), least("ms"), greatest("ms"), total("v"), first_by("v", ["arr"]), last_by("v", ["arr"])]
    out = tumbling(frame(spark, rows), ["key"], "ts", 3000, aggs)
    got = {(r["key"], us(r["window_start"])): (r["n"], r["min_ms"], r["max_ms"], r["sum_v"], r["first_v"], r["last_v"]) for r in out.collect()}
    assert got == {
        ("a", 0): (2, 0, 2999, 11, 5, 6), ("a", 3000): (1, 3000, 3000, 7, 7, 7),
        (None, 3000): (1, 3001, 3001, 8, 8, 8), ("a", -3000): (1, -1, -1, 1, 1, 1),
    }


@pytest.mark.parametrize("size,slide", [(10_000, 5000), (10_000, 1000), (7000, 2000), (2000, 5000)])
def test_sliding(spark, size, slide):
    rows = stream(3)
    out = sliding(frame(spark, rows), ["key"], "ts", size, slide, [count_rows(), total("v")])
    want = {}
    for key, ts, _, v in rows:
        start = ts // slide * slide
        while start > ts - size:
            n, s = want.get((key, start), (0, 0))
            want[key, start] = (n + 1, s + v)
            start -= slide
    assert {(r["key"], us(r["window_start"])): (r["n"], r["sum_v"]) for r in out.collect()} == want


@pytest.mark.parametrize("gap,want", [
    (5, {("a", 1, 1), ("a", 10, 1), ("b", 1, 3), ("c", 6, 2)}),
    (1, {(k, t, n) for k, t, n in F1}),
])
def test_session_fixture(spark, gap, want):
    df = spark.createDataFrame(F1, "key string, ms long, n int").withColumn("ts", from_millis("ms"))
    out = sessions(df, ["key"], "ts", gap, [total("n")])
    assert {(r["key"], us(r["window_start"]), r["sum_n"]) for r in out.collect()} == want


@pytest.mark.parametrize("gap", [50, 400, 100_000])
@pytest.mark.parametrize("heavy", [False, True])
def test_sessions_of_hot_keys(spark, gap, heavy):
    rows = stream(5)
    if heavy:
        rows = [(k, 30_000 if i % 3 == 0 else ts, i, v) for k, ts, i, v in rows]
    df = frame(spark, rows)
    split = plan_split(df, ["key"], ["ts", "arr"], hot_rows=60, buckets=40 if heavy else 7)
    assert split is not None and split.heavy == heavy
    aggs = [count_rows(), total("v"), first_by("arr", ["ts", "arr"])]
    want = set()
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    for key, rs in by_key.items():
        cur = []
        for r in [*rs, None]:
            if cur and (r is None or r[1] - cur[-1][1] > gap):
                want.add((key, cur[0][1], cur[-1][1] + gap, len(cur), sum(x[3] for x in cur), cur[0][2]))
                cur = []
            if r:
                cur.append(r)
    for plan in (None, split):
        out = sessions(df, ["key"], "ts", gap, aggs, plan).collect()
        got = [(r["key"], us(r["window_start"]), us(r["window_end"]), r["n"], r["sum_v"], r["first_arr"]) for r in out]
        assert len(got) == len(want) and set(got) == want


def simulate(rows, size, slide, delay, lateness):
    """Watermark, firings and late rows, one event at a time."""
    marks, log, late = {}, [], []
    high = None
    content, fired = {}, {}
    wm = None

    def closed(end, extra=0):
        return wm is not None and wm >= end - 1 + extra

    for key, ts, arr, v in sorted(rows, key=lambda r: r[2]):
        marks[arr] = wm
        start, taken = ts // slide * slide, False
        while start > ts - size:
            end = start + size
            if not closed(end, lateness):
                taken = True
                content.setdefault((key, start), []).append(v)
                if closed(end):
                    c = content[key, start]
                    fired[key, start] = fired.get((key, start), 0) + 1
                    log.append((key, start, fired[key, start], "again", arr, len(c), sum(c)))
            start -= slide
        if not taken:
            late.append(arr)
        high = ts if high is None else max(high, ts)
        wm = high - delay
        for (k, s), c in content.items():
            if closed(s + size) and (k, s) not in fired:
                fired[k, s] = 1
                log.append((k, s, 1, "on_time", None, len(c), sum(c)))
    for (k, s), c in content.items():
        if (k, s) not in fired:
            log.append((k, s, 1, "on_time", None, len(c), sum(c)))
    return marks, set(log), set(late)


@pytest.mark.parametrize("size,slide,delay,lateness", [(3000, 3000, 500, 1000), (3000, 3000, 500, 0), (4000, 2000, 0, 1500), (3000, 3000, 10_000, 5000)])
@pytest.mark.parametrize("hot_rows", [10**6, 60])
def test_firing_log_and_late_rows(spark, size, slide, delay, lateness, hot_rows):
    rows = stream(7)
    df = frame(spark, rows)
    marks, log, late = simulate(rows, size, slide, delay, lateness)
    marked = watermark_column(df, "ts", ["arr"], delay, plan_split(df, [], ["arr"], buckets=6))
    got_marks = {r["arr"]: r["watermark"] and us(r["watermark"]) for r in marked.collect()}
    assert got_marks == marks
    split = plan_split(df, ["key"], ["arr"], hot_rows=hot_rows, buckets=6)
    out = firing_log(marked, ["key"], "ts", ["arr"], size, [count_rows(), total("v")], lateness, slide, split=split)
    got = [(r["key"], us(r["window_start"]), r["firing"], r["cause"], r["arr"], r["n"], r["sum_v"]) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == log
    last = final_firings(marked, ["key"], "ts", size, [count_rows(), total("v")], lateness, slide).collect()
    want = {}
    for key, start, firing, _, _, n, v in sorted(log, key=lambda r: r[2]):
        want[key, start] = (firing, n, v)
    assert len(last) == len(want)
    assert {(r["key"], us(r["window_start"])): (r["firing"], r["n"], r["sum_v"]) for r in last} == want
    assert {r["arr"] for r in late_rows(marked, "ts", size, lateness, slide).collect()} == late


def test_disorder_within_the_delay_changes_nothing(spark):
    rows = stream(9, disorder=0)
    rnd = random.Random(1)
    shuffled = sorted(rows, key=lambda r: r[1] + rnd.randrange(2000))
    shuffled = [(k, ts, i, v) for i, (k, ts, _, v) in enumerate(shuffled)]
    results = []
    for rs in (rows, shuffled):
        df = frame(spark, rs)
        marked = watermark_column(df, "ts", ["arr"], 2000, plan_split(df, [], ["arr"], buckets=4))
        assert late_rows(marked, "ts", 3000).count() == 0
        log = firing_log(marked, ["key"], "ts", ["arr"], 3000, [count_rows(), total("v")])
        results.append({(r["key"], r["window_start"], r["n"], r["sum_v"], r["firing"]) for r in log.collect()})
    assert results[0] == results[1]


def test_punctuated_lag_and_ascending(spark):
    rows = [("a", 5, 1, 1), ("a", 9, 2, 0), ("a", 7, 3, 1), ("b", 1, 4, 1)]
    df = frame(spark, rows)
    out = watermark_column(df, "ts", ["arr"], 0, None, valid=F.col("v") == 1)
    assert {r["arr"]: r["watermark"] and us(r["watermark"]) for r in out.collect()} == {1: None, 2: 5, 3: 5, 4: 7}
    assert [r["arr"] for r in ascending_violations(df, ["key"], "ts", ["arr"]).collect()] == [3]
    lag = lag_watermark_column(df.withColumn("ingest", from_millis(F.lit(10_000))), "ingest", 3500)
    assert {us(r["watermark"]) for r in lag.collect()} == {6500}
    # A window [0, 3 s) closes when the watermark reaches 2999 ms.
    edge = frame(spark, [("a", 100, 1, 1)])
    for wm, late in ((2998, False), (2999, True)):
        assert edge.withColumn("watermark", from_millis(F.lit(wm))).select(is_late("ts", 3000)).first()[0] is late


@pytest.mark.parametrize("size,slide", [(3000, 1000), (5000, 700), (1000, 999), (2000, 7), (700, 500)])
def test_overlapping_windows_in_three_ways(spark, size, slide):
    rnd = random.Random(size)
    rows = [(rnd.choice(["a", None]), rnd.choice([rnd.randrange(-4000, 4000), 10**6, -1, 0, None]), i, rnd.choice([None, 3, 5]))
            for i in range(40 if slide > 9 else 4)]
    df = spark.createDataFrame(rows, "key string, ms long, arr long, v long").withColumn("ts", from_millis("ms"))
    aggs = [count_rows("n"), total("v", "s"), least("v", "lo"), first_by("arr", ["arr"], "f"), last_by("v", ["arr"], "l"), top_row("v", ["arr"], ["arr"], "t")]
    got = [sorted(map(str, sliding(df, ["key"], "ts", size, slide, aggs, how).collect())) for how in ("copies", "panes", "blocks")]
    assert got[0] == got[1] == got[2] and got[0]


@pytest.mark.parametrize("waited", [["a", "b", "c"], ["a", "never"], ["b"]])
def test_watermark_of_the_slowest_partition(spark, waited):
    rnd = random.Random(8)
    rows = [(rnd.choice(["a", "b", "c", None]), 100 * i + rnd.randrange(-900, 900) if i % 13 else None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "part string, ms long, arr long").withColumn("ts", from_millis("ms")).repartition(3)
    split = plan_split(df, [], ["arr"], buckets=6)
    out = partitioned_watermark_column(df, "ts", "part", waited, ["arr"], 2000, split, valid=F.col("arr") % 7 != 0)
    high, want = {}, {}
    for part, ms, arr in rows:
        want[arr] = min(high.values()) - 2000 if len(high) == len(waited) else None
        if part in waited and ms is not None and arr % 7:
            high[part] = max(high.get(part, ms), ms)
    assert {r["arr"]: r["watermark"] and us(r["watermark"]) for r in out.collect()} == want
    assert out.columns == [*df.columns, "watermark"]


def fires(rows, threshold):
    mark, out = {}, []
    for key, arr, dist in rows:
        if key not in mark:
            mark[key] = dist
        elif dist - mark[key] > threshold:
            out.append((key, arr))
            mark[key] = dist
    return out


@pytest.mark.parametrize("threshold", [0, 3, 50, 700, 10**6])
@pytest.mark.parametrize("shape", ["steady", "jumpy", "back_and_forth"])
def test_delta_fires_of_hot_keys(spark, threshold, shape):
    rnd = random.Random(11)
    rows, dist = [], {}
    for i in range(600):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        step = {"steady": rnd.random() * 4, "jumpy": rnd.choice([0, 0, 1, 90.5]), "back_and_forth": rnd.random() * 60 - 25}[shape]
        dist[key] = dist.get(key, 0.0) + step
        rows.append((key, i, dist[key]))
    df = spark.createDataFrame(rows, "key string, arr long, dist double").repartition(4)
    want = sorted(fires(rows, threshold), key=str)
    for split in (None, plan_split(df, ["key"], ["arr"], hot_rows=100, buckets=8)):
        out = delta_fires(df, ["key"], ["arr"], "dist", threshold, split)
        assert sorted(((r["key"], r["arr"]) for r in out.collect()), key=str) == want


@pytest.mark.parametrize("kind,start,unit", [("long", 2**60, 1), ("decimal(12,3)", Decimal("0.001"), Decimal("0.001")),
                                             ("decimal(30,6)", Decimal(10) ** 20, Decimal("0.000001")), ("long", 2**63 - 10**5, 1)])
@pytest.mark.parametrize("threshold", [0, 7, 400])
def test_delta_fires_compare_without_rounding(spark, kind, start, unit, threshold):
    """Neighbouring values here share a double; with ranges of a few rows the tree of functions has several levels."""
    rnd = random.Random(5)
    rows, at = [], 0
    for i in range(1500):
        at += rnd.choice([0, 1, 1, 2, 9])
        rows.append(("hot" if i % 10 else "cold", i, start + at * unit))
    df = spark.createDataFrame(rows, f"key string, arr long, x {kind}").repartition(4)
    limit = threshold * unit
    want = sorted(fires(rows, limit))
    for split in (None, plan_split(df, ["key"], ["arr"], hot_rows=300, buckets=400)):
        out = delta_fires(df, ["key"], ["arr"], "x", float(limit), split)
        assert dict(out.dtypes)["x"] == ("bigint" if kind == "long" else kind)
        assert sorted((r["key"], r["arr"]) for r in out.collect()) == want
        assert all(r["x"] == rows[r["arr"]][2] for r in out.collect())


def test_delta_tasks_see_a_block_of_functions(spark):
    """What a call of the tree sees is bounded by the neighbours of a block, however many ranges there are."""
    df = spark.range(40_000).select(F.lit("k").alias("k"), "id", (F.col("id") * 3).alias("x"))
    split = plan_split(df, ["k"], ["id"], hot_rows=1000, buckets=2000)
    assert split.ranges > delta.FAN ** 2
    pieces = pd.DataFrame([("k", 0, n, n * 60, n * 60 + 50, n * 60 + 102) for n in range(delta.FAN)],
                          columns=["k", "_block", "_node", "_least", "_upto", "_exit"])
    assert len(delta._compose(100)(pieces)) <= 2 * delta.FAN
    got = [r["id"] for r in delta_fires(df, ["k"], ["id"], "x", 100, split).orderBy("id").collect()]
    assert got == [f[1] for f in fires([("k", i, i * 3) for i in range(40_000)], 100)]


def test_delta_trigger_fixture(spark):
    df = spark.createDataFrame(M1, "id int, speed int, distance double, ms long").withColumn("ts", from_millis("ms"))
    out = delta_trigger_top(df, ["id"], ["ms"], "ts", "distance", "speed", 50, 10_000, ["speed", "ms"])
    got = [(r["ms"], r["top"]["speed"], r["top"]["ms"]) for r in out.orderBy("ms").collect()]
    assert got == [(2000, 60, 2000), (12000, 55, 9000), (13000, 55, 9000)]


@pytest.mark.parametrize("evict", [700, 5000])
def test_delta_trigger_of_hot_keys(spark, evict):
    rnd = random.Random(13)
    rows, dist, ts = [], {}, 0
    for i in range(500):
        key = rnd.choice(["hot", "hot", "a"])
        ts += rnd.choice([0, 0, 50, 300])
        dist[key] = dist.get(key, 0.0) + rnd.random() * 9
        rows.append((key, i, dist[key], ts, rnd.choice([None, 1, 2, 3, 4])))
    df = spark.createDataFrame(rows, "key string, arr long, dist double, ms long, speed int").withColumn("ts", from_millis("ms"))
    at = {(r[0], r[1]): r for r in rows}
    want = {}
    for key, arr in fires([r[:3] for r in rows], 20):
        now = at[key, arr][3]
        inside = [r for r in rows if r[0] == key and r[1] <= arr and r[3] > now - evict and r[4] is not None]
        best = max(inside, key=lambda r: (r[4], -r[1]), default=None)
        want[key, arr] = best and (best[4], best[1])
    for hot in (10**6, 80):
        split = plan_split(df, ["key"], ["arr"], hot_rows=hot, buckets=6)
        tsplit = plan_split(df, ["key"], ["ts", "arr"], hot_rows=hot, buckets=6)
        out = delta_trigger_top(df, ["key"], ["arr"], "ts", "dist", "speed", 20, evict, ["speed", "arr"], split, tsplit)
        got = {(r["key"], r["arr"]): (r["top"]["speed"], r["top"]["arr"]) if r["top"] and r["top"]["speed"] is not None else None for r in out.collect()}
        assert got == want


def test_interval_join(spark):
    rnd = random.Random(2)
    left = [(rnd.choice("ab"), rnd.randrange(20_000), i) for i in range(150)] + [(None, 5, 900), ("a", None, 901)]
    right = [(rnd.choice("ab"), rnd.randrange(20_000), i) for i in range(150)] + [(None, 5, 900), ("a", None, 901)]
    left.append(("c", 1000, 902)), right.extend([("c", 2000, 902), ("c", 0, 903), ("c", 2001, 904)])
    mk = lambda rows: spark.createDataFrame(rows, "key string, ms long, id long").withColumn("ts", from_millis("ms"))
    out = interval_join(mk(left), mk(right), ["key"], "ts", "ts", 1000, 1000)
    want = sorted((l[2], r[2]) for l in left for r in right
                  if l[0] and l[0] == r[0] and None not in (l[1], r[1]) and r[1] - 1000 <= l[1] <= r[1] + 1000)
    assert (902, 902) in want and (902, 903) in want and (902, 904) not in want
    assert sorted((r["l_id"], r["r_id"]) for r in out.collect()) == want
    skew = interval_join(mk(left), mk(right), ["key"], "ts", "ts", 0, 2500)
    assert sorted((r["l_id"], r["r_id"]) for r in skew.collect()) == sorted(
        (l[2], r[2]) for l in left for r in right
        if l[0] and l[0] == r[0] and None not in (l[1], r[1]) and r[1] <= l[1] <= r[1] + 2500)


@pytest.mark.parametrize("hot_rows", [10**6, 60])
def test_window_content(spark, hot_rows):
    rows = stream(4)
    df = frame(spark, rows)
    split = plan_split(df, ["key"], ["ts", "arr"], hot_rows=hot_rows, buckets=5)
    out = window_content(df, ["key"], "ts", 3000, ["arr"], split)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault((r[0], r[1] // 3000), []).append(r[2])
    want = {arr: i + 1 for g in groups.values() for i, arr in enumerate(g)}
    assert {r["arr"]: r["position"] for r in out.collect()} == want


def test_reduce_and_top_in_windows(spark):
    df = frame(spark, stream(6)).withColumn("text", F.col("arr").cast("string"))
    out = tumbling(df, ["key"], "ts", 3000, [joined("text", ["arr"], "|", "ids"), top_row("v", ["arr"], ["v", "arr"], "t")])
    groups = {}
    for key, ts, arr, v in stream(6):
        groups.setdefault((key, ts // 3000 * 3000), []).append((arr, v))
    want = {k: ("|".join(str(a) for a, _ in g), max(g, key=lambda x: (x[1], -x[0]))[0]) for k, g in groups.items()}
    assert {(r["key"], us(r["window_start"])): (r["ids"], r["t"]["arr"]) for r in out.collect()} == want
