"""Stream forms against the table forms and against hand-derived results."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.aggregates import count_rows, first_by, joined, least, total
from tidemark.functions.parse import space_tokens, word_tokens
from tidemark.functions.times import from_millis
from tidemark.operators.countwin import count_sliding, count_tumbling
from tidemark.operators.joins import interval_join, interval_join_stream
from tidemark.operators.relational import filtered_union, register
from tidemark.operators.scan import plan_split
from tidemark.operators.sessions import sessions
from tidemark.operators.watermark import firing_log, late_rows, watermark_column
from tidemark.operators.windows import tumbling
from tidemark.operators.wordcount import windowed_word_count, word_count
from tidemark.sources.readers import read_edits, read_lines, stream_lines
from tidemark.sources.sinks import start, text_per_batch
from tidemark.streaming.late import LateSplit
from tidemark.streaming.stateful import count_windows_stream, delta_top_stream
from tidemark.streaming.windows import session_stream, split_by_clock, stamp_ingest, windowed_stream

F2 = [("a", "123456"), ("b", "7890")]
M1 = [(0, 50, 0.0, 0), (0, 55, 20.0, 1000), (0, 60, 60.0, 2000), (0, 55, 100.0, 9000), (0, 50, 115.0, 12000), (0, 45, 170.0, 13000)]
M2 = [[1000], [2500, 15000], [1500, 12500], [2000, 30000], [13000], [31000]]


@pytest.fixture(scope="module", autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def ms_of(ts):
    return round(ts.timestamp() * 1000)


def as_stream(spark, folder, batches, schema):
    """Each list of rows becomes one file and one micro-batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/in/{i:03d}")
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
        .parquet(f"{folder}/in")
    )


def run(df, folder, mode="append", keep_all=False):
    """All rows a stream emitted, with their batch ids if wanted."""
    seen = []

    def collect(batch, batch_id):
        seen.extend((batch_id, r) for r in batch.collect())

    start(df, f"{folder}/checkpoint", mode, collect).awaitTermination()
    return seen if keep_all else [r for _, r in seen]


def m2_batches():
    n = iter(range(100))
    return [[("a", t, next(n)) for t in batch] for batch in M2]


M2_SCHEMA = "key string, ms long, arr long"


def test_append_windows(spark, tmp_path):
    df = as_stream(spark, tmp_path, m2_batches(), M2_SCHEMA).withColumn("ts", from_millis("ms"))
    out = run(windowed_stream(df, ["key"], "ts", 3000, [count_rows()], 10_000), tmp_path)
    got = {ms_of(r["window_start"]): r["n"] for r in out}
    # Spark's rule: a row one batch late still counts; the window at 30000 stays open.
    assert got == {0: 3, 12000: 2, 15000: 1}


def in_order_batches():
    rows = [("ab"[i % 2] if i % 5 else "c", 700 * i + (i * 37) % 300, i) for i in range(60)]
    return rows, [rows[i:i + 12] for i in range(0, 60, 12)]


@pytest.mark.parametrize("slide", [None, 1500])
def test_update_windows_end_as_the_table_does(spark, tmp_path, slide):
    rows, batches = in_order_batches()
    df = as_stream(spark, tmp_path, batches, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    aggs = [count_rows(), first_by("arr", ["arr"], "f")]
    out = run(windowed_stream(df, ["key"], "ts", 3000, aggs, 500, 1000, slide), tmp_path, "update", keep_all=True)
    last = {}
    for _, r in out:
        last[r["key"], r["window_start"]] = (r["n"], r["f"])
    table = spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    want = tumbling(table, ["key"], "ts", 3000, aggs, slide).collect()
    assert last == {(r["key"], r["window_start"]): (r["n"], r["f"]) for r in want}


def test_sessions(spark, tmp_path):
    rows, batches = in_order_batches()
    batches = [*batches, [("end", 10**7, 999)]]
    df = as_stream(spark, tmp_path, batches, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    out = run(session_stream(df, ["key"], "ts", 1500, [count_rows()], 500), tmp_path)
    table = spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    want = sessions(table, ["key"], "ts", 1500, [count_rows()]).collect()
    pick = lambda rs: {(r["key"], r["window_start"], r["window_end"], r["n"]) for r in rs}
    assert pick(out) == pick(want)


@pytest.mark.parametrize("n,slide", [(3, 3), (3, 2), (2, 5)])
def test_count_windows(spark, tmp_path, n, slide):
    rows = [(k, v) for k, vs in F2 for v in vs]
    rows = [(k, v, i) for i, (k, v) in enumerate(rows)]
    schema = "key string, v string, arr long"
    df = as_stream(spark, tmp_path, [list(reversed(rows[:4])), rows[4:7], rows[7:8], rows[8:]], schema)
    out = run(count_windows_stream(df, ["key"], ["arr"], "v", n, slide), tmp_path)
    table = spark.createDataFrame(rows, schema)
    text = [joined("v", ["arr"], "", "joined")]
    want = count_tumbling(table, ["key"], ["arr"], n, text) if n == slide else count_sliding(table, ["key"], ["arr"], n, slide, text)
    pick = lambda rs: sorted((r["key"], r["window_no"], r["joined"]) for r in rs)
    assert pick(out) == pick(want.collect())
    if (n, slide) == (3, 3):
        assert {r["joined"] for r in out} == {"123", "456", "789"}
    if (n, slide) == (3, 2):
        assert {r["joined"] for r in out} == {"12", "234", "456", "78", "890"}


def test_delta_top(spark, tmp_path):
    schema = "id int, speed int, distance double, ms long"
    df = as_stream(spark, tmp_path, [M1[:2], M1[2:5], M1[5:]], schema).withColumn("ts", from_millis("ms"))
    out = run(delta_top_stream(df, ["id"], ["ms"], "ts", "distance", "speed", 50, 10_000, ["speed", "ms"]), tmp_path)
    got = sorted((ms_of(r["fire_ts"]), r["top"]["speed"], r["top"]["ms"]) for r in out)
    assert got == [(2000, 60, 2000), (12000, 55, 9000), (13000, 55, 9000)]


def test_running_word_count(spark, tmp_path):
    lines = ["To be, or not to be", "that is -- to BE", ""]
    df = as_stream(spark, tmp_path, [[(x,)] for x in lines], "line string")
    out = run(word_count(df, word_tokens("line")), tmp_path, "update", keep_all=True)
    last = {r["word"]: r["n"] for _, r in sorted(out, key=lambda x: x[0])}
    assert last == {"to": 3, "be": 3, "or": 1, "not": 1, "that": 1, "is": 1}
    assert [r["n"] for b, r in sorted(out, key=lambda x: x[0]) if r["word"] == "to"] == [2, 3]


def test_ingest_windows(spark, tmp_path):
    df = as_stream(spark, tmp_path, [[("x y x",)], [("y",)]], "line string")
    out = run(windowed_word_count(stamp_ingest(df), space_tokens("line"), "ingest", 10**9), tmp_path, "update")
    last = {r["word"]: r["n"] for r in out}
    assert last["x"] == 2 and last["y"] in (1, 2)


def test_interval_join(spark, tmp_path):
    a = [[("x", 10, "p"), ("y", 500, "q")], [("x", 5000, "r")], [("x", 60_000, "s")]]
    b = [[("x", 1010, "j1"), ("y", 1501, "j2")], [("x", 4000, "j3")], [("z", 60_000, "j4")]]
    schema = "name string, ms long, v string"
    left = as_stream(spark, tmp_path / "l", a, schema).withColumn("ts", from_millis("ms"))
    right = as_stream(spark, tmp_path / "r", b, schema).withColumn("ts", from_millis("ms"))
    out = run(interval_join_stream(left, right, ["name"], "ts", "ts", 1000, 1000, 2000), tmp_path)
    flat = lambda x: spark.createDataFrame([r for rs in x for r in rs], schema).withColumn("ts", from_millis("ms"))
    want = interval_join(flat(a), flat(b), ["name"], "ts", "ts", 1000, 1000).collect()
    pick = lambda rs: sorted((r["l_v"], r["r_v"]) for r in rs)
    assert pick(out) == pick(want) == [("p", "j1"), ("r", "j3")]


def test_sql_on_streams(spark, tmp_path):
    schema = "user long, product string, amount int"
    a = as_stream(spark, tmp_path / "a", [[(1, "beer", 3), (1, "diaper", 4)], [(3, "rubber", 2)]], schema)
    b = as_stream(spark, tmp_path / "b", [[(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)]], schema)
    out = run(filtered_union(spark, a, register(b, "order_b"), "amount", 2, 2), tmp_path)
    assert sorted(tuple(r) for r in out) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]


def test_split_by_clock(spark, tmp_path):
    now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
    df = as_stream(spark, tmp_path, [[(now + 3_600_000,), (now - 3_600_000,), (None,)]], "ms long")
    fresh, old = split_by_clock(df.withColumn("ts", from_millis("ms")), "ts", 3500)
    assert [r["ms"] for r in run(fresh, tmp_path / "f")] == [now + 3_600_000]
    assert {r["ms"] for r in run(old, tmp_path / "o")} == {now - 3_600_000, None}


def test_late_split_fixture_and_rerun(spark, tmp_path):
    batches = m2_batches()
    df = as_stream(spark, tmp_path, batches, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    split = LateSplit(f"{tmp_path}/out", ["key"], "ts", 3000, [count_rows(), least("ms")], 10_000)
    start(df, f"{tmp_path}/checkpoint", "append", split).awaitTermination()

    def check():
        late = spark.read.schema(f"{M2_SCHEMA}, batch int").parquet(f"{tmp_path}/out/late")
        results = spark.read.parquet(f"{tmp_path}/out/results").unionByName(
            split.flush(spark, len(batches) - 1).withColumn("batch", F.lit(-1)))
        rows = results.collect()
        assert {r["ms"] for r in late.collect()} == {1500, 2000, 13000}
        assert {(ms_of(r["window_start"]), r["n"]) for r in rows} == {(0, 2), (12000, 1), (15000, 1), (30000, 2)}
        assert len(rows) == 4 and not any(r["again"] for r in rows)

    check()
    # The last batch again, as after a failure before its commit.
    again = spark.createDataFrame(batches[-1], M2_SCHEMA).withColumn("ts", from_millis("ms"))
    split(again, len(batches) - 1)
    check()


@pytest.mark.parametrize("size,slide,lateness", [(3000, 3000, 0), (3000, 3000, 2500), (4000, 2000, 1500)])
def test_late_split_row_by_row_is_the_firing_log(spark, tmp_path, size, slide, lateness):
    times = [1000, 4200, 2500, 900, 7000, 3900, 5200, 12000, 6900, 100, 9500, 15000]
    rows = [("ab"[i % 3 == 0], t, i) for i, t in enumerate(times)]
    split = LateSplit(f"{tmp_path}/out", ["key"], "ts", size, [count_rows(), total("arr")], 1000, lateness, slide)
    for i, row in enumerate(rows):
        split(spark.createDataFrame([row], M2_SCHEMA).withColumn("ts", from_millis("ms")), i)
    results = spark.read.parquet(f"{tmp_path}/out/results").drop("batch").unionByName(split.flush(spark, len(rows) - 1))
    got = sorted((r["key"], ms_of(r["window_start"]), r["n"], r["sum_arr"], r["again"]) for r in results.collect())
    table = spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms"))
    marked = watermark_column(table, "ts", ["arr"], 1000, plan_split(table, [], ["arr"]))
    log = firing_log(marked, ["key"], "ts", ["arr"], size, [count_rows(), total("arr")], lateness, slide).collect()
    want = sorted((r["key"], ms_of(r["window_start"]), r["n"], r["sum_arr"], r["firing"] > 1) for r in log)
    assert got == want
    late = spark.read.schema(f"{M2_SCHEMA}, batch int").parquet(f"{tmp_path}/out/late").collect()
    assert {r["arr"] for r in late} == {r["arr"] for r in late_rows(marked, "ts", size, lateness, slide).collect()}


def test_text_files_in_and_out(spark, tmp_path):
    for i, text in enumerate(["b,2\na,1\n", "c,3\n"]):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.txt").write_text(text)
    lines = read_lines(spark, f"{tmp_path}/in/0.txt")
    assert [r["value"] for r in lines.orderBy("arr").collect()] == ["b,2", "a,1"]
    stream = stream_lines(spark, f"{tmp_path}/in", max_files=1)
    sink = text_per_batch(F.upper("value"), f"{tmp_path}/out")
    start(stream, f"{tmp_path}/checkpoint", "append", sink).awaitTermination()
    out = spark.read.text(f"{tmp_path}/out")
    assert sorted(r["value"] for r in out.collect()) == ["A,1", "B,2", "C,3"]


def test_edit_feed(spark, tmp_path):
    (tmp_path / "edits").mkdir()
    (tmp_path / "edits" / "1.json").write_text('{"user":"u","byteDiff":5,"x":1}\nnoise\n{"user":"u","byteDiff":-2}\n')
    assert sorted(r["byte_diff"] for r in read_edits(spark, f"{tmp_path}/edits").collect()) == [-2, 5]
    stream = stamp_ingest(read_edits(spark, f"{tmp_path}/edits", streaming=True))
    out = run(tumbling(stream, ["user"], "ingest", 10**9, [total("byte_diff", "bytes")]), tmp_path, "update")
    assert [(r["user"], r["bytes"]) for r in out] == [("u", 3)]


def test_parquet_sink(spark, tmp_path):
    df = as_stream(spark, tmp_path, [[("a", 1, 1)], [("b", 2, 2)]], M2_SCHEMA)
    start(df, f"{tmp_path}/checkpoint", path=f"{tmp_path}/files").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/files").count() == 2


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    """A stopped stream goes on where it was: state, watermark snapshot and outputs."""
    rows = [("a", str(i), i) for i in range(8)]
    schema = "key string, v string, arr long"
    as_stream(spark, tmp_path, [rows[:4]], schema)
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    windows = count_windows_stream(stream, ["key"], ["arr"], "v", 3)
    first = run(windows, tmp_path)
    spark.createDataFrame(rows[4:], schema).coalesce(1).write.parquet(f"{tmp_path}/in/001")
    second = run(windows, tmp_path)
    assert [r["joined"] for r in first] == ["012"] and [r["joined"] for r in second] == ["345"]


def test_late_split_restart(spark, tmp_path):
    batches = m2_batches()
    for i, rows in enumerate(batches[:3]):
        spark.createDataFrame(rows, M2_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{i:03d}")
    stream = (
        spark.readStream.schema(M2_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
        .parquet(f"{tmp_path}/in").withColumn("ts", from_millis("ms"))
    )
    for part in (batches[3:5], batches[5:], []):
        split = LateSplit(f"{tmp_path}/out", ["key"], "ts", 3000, [count_rows()], 10_000)
        start(stream, f"{tmp_path}/checkpoint", "append", split).awaitTermination()
        done = len(list((tmp_path / "in").iterdir()))
        for i, rows in enumerate(part):
            spark.createDataFrame(rows, M2_SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{done + i:03d}")
    late = spark.read.schema(f"{M2_SCHEMA}, batch int").parquet(f"{tmp_path}/out/late").collect()
    assert {r["ms"] for r in late} == {1500, 2000, 13000}
    results = spark.read.parquet(f"{tmp_path}/out/results").collect()
    assert {(ms_of(r["window_start"]), r["n"]) for r in results} == {(0, 2), (12000, 1), (15000, 1)}
    # Only the states of the last two batches are kept.
    assert sorted(p.name for p in (tmp_path / "out" / "state").iterdir()) == ["batch=4", "batch=5"]


def entries_of(tmp_path):
    """Files of states by kind, batch and bucket."""
    found = {p.relative_to(tmp_path / "out").parent.as_posix() for kind in ("appends", "base")
             for p in (tmp_path / "out" / kind).rglob("*.parquet")}
    return {(k, int(b.split("=")[1]), int(n.split("=")[1])) for k, b, n in (x.split("/") for x in found)}


def test_late_split_writes_what_a_batch_touches(spark, tmp_path):
    """One key in a batch: one bucket is written, whatever else is open; many appends become one table; over windows go."""
    split = LateSplit(f"{tmp_path}/out", ["key"], "ts", 3000, [count_rows(), total("arr")], 1000, 2000, buckets=64, entries=3)
    keys = [f"k{i}" for i in range(200)]
    batches = [[(k, 1000, 1) for k in keys]] + [[("k7", 1500, i)] for i in range(2, 9)] + [[("k7", 60_000, 9)], [("k7", 61_000, 10)]]
    seen = set()
    for i, rows in enumerate(batches):
        split(spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms")), i)
        now = entries_of(tmp_path)
        written = {e for e in now - seen if e[1] == i}
        assert i == 0 or {e[2] for e in written} == {next(iter(written))[2]}
        seen |= now
    high, log = split._state(spark, len(batches) - 1)
    assert high == 61_000_000 and all(len(s.appends) < 3 for s in log.values())
    mine = next(b for b, s in log.items() if s.ends)
    assert {k for k, _, b in now if b == mine} <= {"base", "appends"} and len([e for e in now if e[2] == mine]) <= 6
    results = spark.read.parquet(f"{tmp_path}/out/results").collect()
    got = {(r["key"], ms_of(r["window_start"])): r["n"] for r in results}
    assert got == {(k, 0): 1 + 7 * (k == "k7") for k in keys} and len(results) == 200
    assert [(r["key"], r["n"]) for r in split.flush(spark, len(batches) - 1).collect()] == [("k7", 2)]


def test_late_split_rerun_of_any_batch(spark, tmp_path):
    """Each batch runs twice, the second time as after a failure before its commit; results are those of single runs."""
    import random

    rnd = random.Random(3)
    batches = [[(rnd.choice("abcd"), 900 * i + rnd.randrange(-9000, 1500), 10 * i + j) for j in range(rnd.randrange(2, 6))] for i in range(7)]
    outs = []
    for runs, folder in ((1, "once"), (2, "twice")):
        split = LateSplit(f"{tmp_path}/{folder}", ["key"], "ts", 3000, [count_rows(), total("arr")], 1000, 1500, 1500, buckets=3, entries=2)
        for i, rows in enumerate(batches):
            for _ in range(runs):
                split(spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms")), i)
        results = spark.read.parquet(f"{tmp_path}/{folder}/results")
        late = spark.read.schema(f"{M2_SCHEMA}, batch int").parquet(f"{tmp_path}/{folder}/late")
        outs.append([sorted(map(str, df.collect())) for df in (results, late, split.flush(spark, len(batches) - 1))])
    assert outs[0] == outs[1] and all(outs[0])


def test_interval_join_spreads_a_hot_key_and_forgets(spark, tmp_path):
    """One key for all rows: the cell is in the key of the state, and state follows the watermark, not the input."""
    schema = "name string, ms long, v long"
    sides = [[[("x", 10**6 + 1000 * (10 * i + j) + off, 10 * i + j) for j in range(10)] for i in range(12)] for off in (0, 400)]
    left, right = (as_stream(spark, tmp_path / n, s, schema).withColumn("ts", from_millis("ms")) for n, s in zip("lr", sides))
    joined_ = interval_join_stream(left, right, ["name"], "ts", "ts", 1000, 1000, 0)
    seen = []
    query = start(joined_, f"{tmp_path}/checkpoint", "append", lambda b, i: seen.extend((r["l_v"], r["r_v"]) for r in b.collect()))
    query.awaitTermination()
    flat = lambda s: spark.createDataFrame([r for rs in s for r in rs], schema).withColumn("ts", from_millis("ms"))
    want = interval_join(flat(sides[0]), flat(sides[1]), ["name"], "ts", "ts", 1000, 1000).collect()
    assert sorted(seen) == sorted((r["l_v"], r["r_v"]) for r in want) and len(seen) == 2 * 120 - 1
    kept = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) <= 90 and kept[-1] <= 60
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert all("_cell" in k for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan)) and "hashpartitioning" in plan


def test_console_and_period(spark, tmp_path, capfd):
    df = as_stream(spark, tmp_path, [[("a", 1, 1)]], M2_SCHEMA)
    query = start(df, f"{tmp_path}/checkpoint", console=True, every_ms=200)
    query.processAllAvailable()
    query.stop()
    assert not query.isActive and query.exception() is None
    with pytest.raises(ValueError):
        start(df, f"{tmp_path}/other")


def test_delta_stream_agrees_with_the_table(spark, tmp_path):
    import random

    from tidemark.operators.delta import delta_trigger_top

    rnd = random.Random(4)
    rows, dist, now = [], {}, 1000
    for i in range(160):
        key = rnd.choice(["a", "b", None])
        now += rnd.choice([0, 40, 300])
        dist[key] = dist.get(key, 2**60) + rnd.randrange(9)
        rows.append((key, i, dist[key], now, rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice([None, "x", 'q"é'])))
    schema = "key string, arr long, dist long, ms long, speed int, note string"
    batches = [rows[:50], rows[50:52], rows[52:90], rows[90:]]
    df = as_stream(spark, tmp_path, batches, schema).withColumn("ts", F.timestamp_micros(F.col("ms") * 1000 + F.col("arr")))
    fields = ["speed", "note", "ts", "dist"]
    out = run(delta_top_stream(df, ["key"], ["arr"], "ts", "dist", "speed", 20, 1500, fields), tmp_path)
    table = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_micros(F.col("ms") * 1000 + F.col("arr")))
    want = delta_trigger_top(table, ["key"], ["arr"], "ts", "dist", "speed", 20, 1500, fields)
    pick = lambda r: (str(r["key"]), r["arr"], r["fire_ts"], r["top"] and tuple(r["top"]) if r["top"] and r["top"]["speed"] is not None else None)
    assert sorted(map(pick, out)) == sorted(map(pick, want.collect())) and len(out) > 10
    assert out[0].__fields__ == want.columns


def test_ordered_reduce_on_a_stream(spark, tmp_path):
    """Sum of counts and times joined in arrival order, per window, as a stream in update mode."""
    rows = [("a", 1000, 3), ("a", 2000, 1), ("b", 2500, 2), ("a", 8000, 0), ("a", 11_000, 4)]
    df = as_stream(spark, tmp_path, [rows[:3], rows[3:]], M2_SCHEMA).withColumn("ts", from_millis("ms"))
    df = df.withColumn("text", F.col("ms").cast("string"))
    out = run(windowed_stream(df, ["key"], "ts", 10_000, [total("arr"), joined("text", ["arr"], "|", "t")], 5000), tmp_path, "update", True)
    last = {(r["key"], ms_of(r["window_start"])): (r["sum_arr"], r["t"]) for _, r in out}
    assert last == {("a", 0): (4, "8000|2000|1000"), ("b", 0): (2, "2500"), ("a", 10_000): (4, "11000")}


def test_late_split_with_empty_batches(spark, tmp_path):
    split = LateSplit(f"{tmp_path}/out", ["key"], "ts", 3000, [count_rows()], 0)
    for i, rows in enumerate([[], [("a", 1000, 0), ("a", None, 1)], [], [("a", 9000, 2), ("a", 500, 3)], [("a", 600, 4)]]):
        split(spark.createDataFrame(rows, M2_SCHEMA).withColumn("ts", from_millis("ms")), i)
    results = spark.read.parquet(f"{tmp_path}/out/results").collect()
    assert {(ms_of(r["window_start"]), r["n"]) for r in results} == {(0, 2)}
    assert [(ms_of(r["window_start"]), r["n"]) for r in split.flush(spark, 4).collect()] == [(9000, 1)]
    late = spark.read.schema(f"{M2_SCHEMA}, batch int").parquet(f"{tmp_path}/out/late").collect()
    assert [r["arr"] for r in late] == [4]
