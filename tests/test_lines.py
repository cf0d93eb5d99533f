"""Parsers, tokens, payloads, sinks and the jobs over text lines."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse as P
from tidemark.functions import payload
from tidemark.functions.aggregates import Agg, count_rows, folded, joined
from tidemark.functions.times import COMPACT, as_timestamp, from_millis, millis_to_text, text_to_millis
from tidemark.operators import relational as R
from tidemark.operators.countwin import count_sliding, count_tumbling
from tidemark.operators.windows import tumbling
from tidemark.operators.wordcount import running_count, windowed_word_count, word_count, words
from tidemark.plans import jobs
from tidemark.sources.readers import from_rows, replay
from tidemark.sources.staging import staged
from tidemark.sources.sinks import kafka_options, merge_statement, text_per_batch, write_text

F2 = [("a", v) for v in "123456"] + [("b", v) for v in "7890"]
F5 = ["To be, or not to be,--that is the question:--", "Whether 'tis nobler in the mind to suffer",
      "The slings and arrows of outrageous fortune", "Or to take arms against a sea of troubles,"]


def lines(spark, texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, arr long")


def java_split(text, sep):
    """What the lines' original reader does: no trailing empty parts, but one empty part for empty text."""
    if text == "":
        return [""]
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_and_space_tokens(spark):
    texts = ["", " ", "   ", "a", " a", "a ", "a  b", " a  b  ", "a \n", "\n ", ",a", None]
    rows = lines(spark, texts).select("value", P.space_tokens("value").alias("t"), P.split_like_java(F.col("value"), ",").alias("c"))
    for r in rows.collect():
        if r["value"] is None:
            assert r["t"] is None and r["c"] is None
        else:
            assert r["t"] == java_split(r["value"], " "), repr(r["value"])
            assert r["c"] == java_split(r["value"], ",")


def test_word_tokens(spark):
    out = lines(spark, ["--To be, or", "", "!!", "x_1 É"]).select(P.word_tokens("value").alias("t")).collect()
    assert [r["t"] for r in out] == [["to", "be", "or"], [], [], ["x_1"]]


GOOD_AND_BAD = [
    (P.CAR_TEXT, "bus@1500@3", ("bus", 1500, 3), ["bus@x@3", "bus@1", "", "bus@1@", "bus@1@2.5"]),
    (P.CAR_JSON_LINE, '{"carKind":"1","timeStamp":5,"carSum":2,"other":9}', ("1", 5, 2), ["nope", "[1]", ""]),
    (P.KEYED, "a,1500", ("a", 1500), ["a", "a,b", ""]),
    (P.COUNTED, "a,3,20180102-030405", ("a", 3, "20180102-030405", 1514862245000), ["a,3", "a,x,20180102-030405", "a,1,2,3", "a,1,"]),
    (P.COUNTED, "a,3,never", ("a", 3, "never", 0), []),
    (P.PERSON, "Mike,20,MALE,more", ("Mike", "20", "MALE"), ["Mike,20", "Mike,20,"]),
    (P.JOB, "Mike\tbuilder now", ("Mike", "builder"), ["Mike", "Mike ", ""]),
    (P.TELEMETRY, "(1,55,15.277777777777777,1424952007664)", (1, 55, 15.277777777777777, 1424952007664), ["(1,55,x,1)", "()", "", "("]),
    (P.EDIT_JSON, '{"user":"u","byteDiff":-7}', ("u", -7), ['{"user":"u"}', "x"]),
]


@pytest.mark.parametrize("case", range(len(GOOD_AND_BAD)))
def test_parsers(spark, case):
    parser, good, want, bad = GOOD_AND_BAD[case]
    df = lines(spark, [good, *bad, None])
    out = P.parse(df, parser, "quarantine")
    row = out.rows.collect()
    assert [tuple(r)[1:] for r in row] == [want] and row[0]["arr"] == 0
    assert [r["value"] for r in out.bad.orderBy("arr").collect()] == [*bad, None]
    assert P.parse(df, parser, "drop").rows.count() == 1
    assert P.parse(lines(spark, [good]), parser, "fail").rows.count() == 1
    with pytest.raises(Exception, match="malformed line"):
        P.parse(df, parser, "fail").rows.collect()
    with pytest.raises(ValueError):
        P.parse(df, parser, "skip")


def test_json_missing_fields_are_null(spark):
    out = P.parse(lines(spark, ['{"carKind":"1"}', "{}"]), P.CAR_JSON_LINE, "fail").rows.orderBy("arr").collect()
    assert [tuple(r)[1:] for r in out] == [("1", None, None), (None, None, None)]


def test_times(spark):
    df = spark.createDataFrame([("20180102-120405",), ("2018",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_millis("t")).collect()] == [1514894645000, 0, 0]
    one = spark.range(1).select(millis_to_text(F.lit(1500)).alias("s"), millis_to_text(F.lit(1500), "yyyy-MM-dd HH:mm:ss.SSS").alias("m"))
    assert tuple(one.first()) == ("1970-01-01 00:00:01", "1970-01-01 00:00:01.500")
    for kind in ("1500L", "TIMESTAMP_NTZ '1970-01-01 00:00:01.5'", "TIMESTAMP '1970-01-01 00:00:01.5'"):
        got = as_timestamp(spark.sql(f"SELECT {kind} AS t"), "t").select(F.unix_millis("t")).first()[0]
        assert got == 1500
    assert COMPACT == "yyyyMMdd-HHmmss"


def test_batch_word_count(spark):
    out = word_count(from_rows(spark, [(x,) for x in F5], "line string"), P.word_tokens("line"))
    got = {r["word"]: r["n"] for r in out.collect()}
    assert len(got) == 26 and got["to"] == 4 and got["the"] == 3
    assert {w for w, n in got.items() if n == 2} == {"be", "of", "or"}
    assert sum(1 for n in got.values() if n == 1) == 21


def test_running_and_windowed_word_count(spark):
    df = words(lines(spark, ["x y x", "y x"]).withColumn("ts", from_millis("arr")), P.space_tokens("value"), ["arr"])
    df = df.withColumn("pos", F.monotonically_increasing_id())
    out = running_count(df, ["word"], ["arr", "pos"]).orderBy("arr", "pos").collect()
    assert [(r["word"], r["running_n"]) for r in out] == [("x", 1), ("y", 1), ("x", 2), ("y", 2), ("x", 3)]
    timed = lines(spark, ["x y x", "y x"]).withColumn("ts", from_millis(F.col("arr") * 5000))
    win = windowed_word_count(timed, P.space_tokens("value"), "ts", 5000)
    assert {(r["word"], r["n"]) for r in win.collect()} == {("x", 2), ("y", 1), ("x", 1)}


def test_count_window_fixture(spark):
    df = replay(spark, [(k, v, i) for i, (k, v) in enumerate(F2)], "key string, v string, ms bigint", "ms")
    text = [joined("v", ["arr"], "", "t")]
    assert {(r["key"], r["t"]) for r in count_tumbling(df, ["key"], ["arr"], 3, text).collect()} == {("a", "123"), ("a", "456"), ("b", "789")}
    assert {(r["key"], r["t"]) for r in count_sliding(df, ["key"], ["arr"], 3, 2, text).collect()} == {
        ("a", "12"), ("a", "234"), ("a", "456"), ("b", "78"), ("b", "890")}


def test_user_functions(spark):
    """A fold with a start value, and an aggregate a user writes: a product that merges."""
    df = replay(spark, [("a", 2, 1), ("a", 5, 2), ("a", 10, 3), ("b", 7, 4)], "key string, v bigint, ms bigint", "ms")
    fold = folded("v", ["arr"], F.lit("s"), lambda acc, x: F.concat(acc, F.lit("-"), x.cast("string")), "f")
    logs = Agg("p", {"": F.ln("v")}, lambda s: {"": F.sum(s[""])}, lambda s: F.round(F.exp(s[""])).cast("bigint"))
    out = tumbling(df, ["key"], "ts", 1000, [fold, logs, count_rows()])
    assert {r["key"]: (r["f"], r["p"], r["n"]) for r in out.collect()} == {"a": ("s-2-5-10", 100, 3), "b": ("s-7", 7, 1)}


def test_small_sql(spark):
    a = from_rows(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], "user long, product string, amount int")
    b = R.register(from_rows(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], "x long, y string, z int"), "order_b", ["user", "product", "amount"])
    out = R.filtered_union(spark, a, spark.table("order_b"), "amount", 2, 2).collect()
    assert sorted(tuple(r) for r in out) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]
    assert b.columns == ["user", "product", "amount"]
    orders = from_rows(spark, [(i, 9, "action2" if i == 2 else "action1", 200.0) for i in range(1, 7)], "id long, dealid int, action string, amount double")
    assert R.project(spark, orders, ["id", "amount"]).collect() == orders.select("id", "amount").collect()
    twice = orders.withColumn("arr", F.lit(1)).unionByName(orders.withColumn("arr", F.lit(2)).withColumn("amount", F.lit(5.0)))
    latest = R.latest_by_key(twice, ["id"], ["arr"]).collect()
    assert len(latest) == 6 and {r["amount"] for r in latest} == {5.0}
    numbers = from_rows(spark, [(i,) for i in range(1, 8)], "n int")
    assert [r["square"] for r in R.squares(numbers, "n").collect()] == [1, 4, 9, 16, 25, 36, 49]
    assert [r["n"] for r in R.evens(numbers, "n").collect()] == [2, 4, 6]
    tops = R.top_rows(from_rows(spark, [("a", 5, 2), ("a", 5, 1), ("a", None, 0), ("b", None, 3)], "k string, v int, arr int"), ["k"], "v", ["arr"])
    assert {(r["k"], r["arr"]) for r in tops.collect() if r["v"] is not None} == {("a", 1)}


def test_payloads(spark):
    car = from_rows(spark, [("2", 1500, 1), (None, 1, None)], "kind string, ms long, n int")
    out = payload.json_messages(car, {"carKind": "kind", "timeStamp": "ms", "carSum": "n"}).collect()
    assert out[0]["key"] == out[0]["value"] == '{"carKind":"2","timeStamp":1500,"carSum":1}'
    assert payload.line_messages(car.limit(1), ["kind", "n"]).first()["value"] == "2,1"
    assert kafka_options("h:1", "sql") == {"kafka.bootstrap.servers": "h:1", "topic": "sql"}


def test_result_lines(spark):
    out = jobs.car_windows(lines(spark, ["bus@4000@2", "bus@3500@5"]))
    assert out.select(payload.range_line("car_kind")).first()[0] == (
        "key:bus,  window:[ 1970-01-01 00:00:03  ,  1970-01-01 00:00:06 ), elements count:2, "
        "elements time range:[ 1970-01-01 00:00:03  ,  1970-01-01 00:00:04 ]|||7")
    keyed = jobs.keyed_windows(lines(spark, ["a,4000", "a,3500"]))
    assert keyed.select(payload.comma_line()).first()[0] == (
        "(a),2,1970-01-01 00:00:03.500,1970-01-01 00:00:04.000,1970-01-01 00:00:03.000,1970-01-01 00:00:06.000")
    slid = jobs.car_sliding(lines(spark, ['{"carKind":"1","timeStamp":7000,"carSum":2}']))
    assert {tuple(r) for r in slid.select(payload.sum_line("car_kind"), payload.click_line()).collect()} == {("key:1    carSum:  2", "clickNum:1")}
    assert slid.count() == 2


def test_car_windows_by_arrival(spark):
    texts = ['{"carKind":"1","timeStamp":%d,"carSum":%d}' % x for x in [(2000, 1), (1000, 2), (2500, 3), (1500, 4)]]
    r = jobs.car_windows_by_arrival(lines(spark, texts), ["arr"]).first()
    assert (r["n"], r["first_ts"].microsecond, r["last_ts"].microsecond, r["total"]) == (4, 0, 500_000, 10)
    assert r["first_ts"].second == 2 and r["last_ts"].second == 1


def test_car_firings(spark):
    # Watermark 3.5 s behind; the row at 1.0 s finds its window closed but within 5 s, the row at 0.5 s comes too late.
    texts = ["k@2000@1", "k@7000@1", "k@1000@1", "k@12000@1", "k@500@1"]
    log, late = jobs.car_firings(lines(spark, texts), ["arr"])
    got = {(r["window_start"].second, r["firing"], r["cause"], r["n"]) for r in log.collect()}
    assert got == {(0, 1, "on_time", 1), (0, 2, "again", 2), (6, 1, "on_time", 1), (12, 1, "on_time", 1)}
    assert [r["arr"] for r in late.collect()] == [4]


def test_counted_messages(spark):
    texts = ["a,1,20180101-000001", "a,2,20180101-000009", "b,5,20180101-000001", "a,4,20180101-000010", "bad", "a,1"]
    out = jobs.counted_messages(lines(spark, texts), ["arr"])
    assert {(r["key"], r["total"], r["times"]) for r in out.collect()} == {
        ("a", 3, "20180101-000001|20180101-000009"), ("b", 5, "20180101-000001"), ("a", 4, "20180101-000010")}


@pytest.mark.parametrize("stage", [False, True])
def test_top_speed(spark, tmp_path, monkeypatch, stage):
    texts = ["(0,50,0.0,0)", "(0,55,20.0,1000)", "(0,60,60.0,2000)", "(0,55,100.0,9000)", "(0,50,115.0,12000)", "(0,45,170.0,13000)"]
    if stage:
        monkeypatch.setattr(jobs, "staged", lambda df: staged(df, str(tmp_path)))
    out = jobs.top_speed(lines(spark, texts), ["arr"]).orderBy("arr").collect()
    assert [(r["arr"], r["top"]["speed"], r["top"]["ts_ms"]) for r in out] == [(2, 60, 2000), (4, 55, 9000), (5, 55, 9000)]
    assert len(list(tmp_path.iterdir())) == int(stage)


def test_people_with_jobs(spark):
    people = lines(spark, ["Mike,20,MALE", "John,30,MALE", "broken"]).withColumn("at", from_millis(F.col("arr") * 1000))
    work = lines(spark, ["Mike builder", "John cook", "alone"]).withColumn("at", from_millis(F.col("arr") * 2500 + 1000))
    out = jobs.people_with_jobs(people.drop("arr"), work.drop("arr"), "at").collect()
    assert [tuple(r)[:4] for r in out] == [("Mike", "20", "MALE", "builder")]


def test_bytes_per_user(spark):
    edits = from_rows(spark, [("u", 5, 0), ("u", -7, 4999), ("u", 1, 5000)], "user string, byte_diff long, ms long")
    out = jobs.bytes_per_user(edits.withColumn("ingest", from_millis("ms")), "ingest")
    assert sorted(r["bytes"] for r in out.collect()) == [-2, 1]


def test_arithmetic(spark):
    r = spark.range(1).select(P.metres_per_second(F.lit(36.0)), P.clamp(F.lit(105), 0, 100), P.clamp(F.lit(-5), 0, 100)).first()
    assert tuple(r) == (10.0, 100, 0)


def test_text_sinks(spark, tmp_path):
    df = lines(spark, ["a", "b"])
    for _ in range(2):
        write_text(df, F.concat_ws(":", "value", "arr"), f"{tmp_path}/t")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/t").collect()) == ["a:0", "b:1"]
    with pytest.raises(Exception, match="exists"):
        write_text(df, F.col("value"), f"{tmp_path}/t", overwrite=False)
    sink = text_per_batch(F.col("value"), f"{tmp_path}/s")
    for batch_id in (0, 1, 1):
        sink(df, batch_id)
    assert spark.read.text(f"{tmp_path}/s").count() == 4


def test_merge_statement():
    assert merge_statement("orders", "orders_stage", ["id"], ["id", "action", "amount"]).replace(" OR t.id IS NULL AND s.id IS NULL", "").replace("(t.id = s.id)", "t.id = s.id") == (
        "MERGE INTO orders AS t USING orders_stage AS s ON t.id = s.id"
        " WHEN MATCHED THEN UPDATE SET action = s.action, amount = s.amount"
        " WHEN NOT MATCHED THEN INSERT (id, action, amount) VALUES (s.id, s.action, s.amount)")
    assert "UPDATE" not in merge_statement("t", "s", ["a"], ["a"])
