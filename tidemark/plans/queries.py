"""Registered queries over the driver tables.  Each covers the whole of its tables; ``oracles.py`` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parse as P
from tidemark.functions import payload
from tidemark.functions.aggregates import (
    count_rows, first_by, folded, greatest, joined, last_by, least, top_row, total,
)
from tidemark.functions.times import COMPACT, MILLIS, SECONDS, as_timestamp, from_millis, millis_to_text, text_to_millis
from tidemark.operators import relational as R
from tidemark.operators.countwin import count_sliding, count_tumbling
from tidemark.operators.delta import delta_trigger_top
from tidemark.operators.joins import interval_join
from tidemark.operators.scan import plan_split, scan
from tidemark.operators.sessions import sessions
from tidemark.operators.watermark import (
    ascending_violations, behind_watermark, final_firings, firing_log, lag_watermark_column, late_rows, partitioned_watermark_column,
    watermark_column,
)
from tidemark.operators.windows import BLOCKS, COPIES, concat_in_order, sliding, tumbling, window_content, window_start
from tidemark.operators.wordcount import running_count, windowed_word_count, word_count
from tidemark.plans import jobs
from tidemark.sources.staging import staged

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
ARRIVAL = ["arr", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Zone-less times are read as UTC, and windows are aligned to it.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an arrival order that disagrees with their time."""
    return as_timestamp(table(spark, sf_dir, "events"), "ts").withColumn(
        "arr", F.col("event_id") + (F.col("event_id") * 37) % 101
    )


def plain_times(df: DataFrame) -> DataFrame:
    """Zone-less times for comparison with SQL engines that have no zone."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema
    ])


def money(col: str) -> Column:
    return F.round(F.col(col), 4).alias(col)


def tumble_stats(spark, d):
    aggs = [count_rows("n"), least("ts", "min_ts"), greatest("ts", "max_ts"), total("value", "sum_value")]
    out = tumbling(events(spark, d), ["user_id"], "ts", DAY, aggs)
    return plain_times(out.withColumn("sum_value", money("sum_value")))


def tumble_first_last(spark, d):
    aggs = [count_rows("n"), first_by("ts", ARRIVAL, "first_ts"), last_by("ts", ARRIVAL, "last_ts"), total("value", "sum_value")]
    out = tumbling(events(spark, d), ["user_id"], "ts", DAY, aggs)
    return plain_times(out.withColumn("sum_value", money("sum_value")))


def tumble_sum_first(spark, d):
    aggs = [total("event_id", "sum_id"), first_by("event_type", ARRIVAL, "event_type")]
    return plain_times(tumbling(events(spark, d), ["user_id"], "ts", 6 * HOUR, aggs))


def slide_sum(spark, d):
    out = sliding(events(spark, d), ["user_id"], "ts", 2 * HOUR, HOUR, [total("value", "sum_value")], COPIES)
    return plain_times(out.withColumn("sum_value", money("sum_value")))


def sum_lines(spark, d):
    """Printed lines of a sliding sum; 10 hours every 4 is no whole number of slides."""
    out = sliding(events(spark, d), ["user_id"], "ts", 10 * HOUR, 4 * HOUR, [total("event_id", "total")])
    return out.select("user_id", F.unix_millis("window_start").alias("start_ms"), payload.sum_line("user_id").alias("line"))


def click_lines(spark, d):
    """Printed lines of a sliding count."""
    out = sliding(events(spark, d), ["event_type"], "ts", 2 * HOUR, HOUR, [count_rows("n")], COPIES)
    return out.select("event_type", F.unix_millis("window_start").alias("start_ms"), payload.click_line().alias("line"))


def slide_count(spark, d):
    return plain_times(sliding(events(spark, d), ["user_id"], "ts", 2 * HOUR, HOUR, [count_rows("n")], COPIES))


def slide_panes(spark, d):
    aggs = [count_rows("n"), least("ts", "min_ts"), last_by("event_id", ARRIVAL, "last_id")]
    return plain_times(sliding(events(spark, d), ["user_id"], "ts", DAY, 2 * HOUR, aggs))


def slide_blocks(spark, d):
    """A day every ten minutes: 144 windows over each row."""
    aggs = [count_rows("n"), least("ts", "min_ts"), last_by("event_id", ARRIVAL, "last_id"), total("user_id", "sum_user")]
    return plain_times(sliding(events(spark, d), ["event_type"], "ts", DAY, 10 * MINUTE, aggs, BLOCKS))


def session_sum(spark, d):
    ev = events(spark, d)
    aggs = [count_rows("n"), total("value", "sum_value"), first_by("event_type", ARRIVAL, "event_type")]
    out = sessions(ev, ["user_id"], "ts", 6 * HOUR, aggs, plan_split(ev, ["user_id"], ["ts", *ARRIVAL]))
    return plain_times(out.withColumn("sum_value", money("sum_value")))


def ingest_window_fold(spark, d):
    edits = events(spark, d).select(
        F.col("user_id").alias("user"), F.col("event_id").alias("byte_diff"), F.col("ts").alias("ingest")
    )
    return plain_times(jobs.bytes_per_user(edits, "ingest", 12 * HOUR))


def documents_word_count(spark, d):
    return word_count(table(spark, d, "documents"), P.word_tokens("text"))


def conversations_word_count(spark, d):
    return word_count(table(spark, d, "conversations"), P.space_tokens("text"))


def window_word_count(spark, d):
    return plain_times(windowed_word_count(events(spark, d), P.word_tokens("props"), "ts", DAY))


def event_running_count(spark, d):
    ev = events(spark, d)
    out = running_count(ev, ["event_type"], ARRIVAL, plan_split(ev, ["event_type"], ARRIVAL))
    return out.select("event_id", "event_type", "running_n")


def word_running_count(spark, d):
    order = ["conv_id", "turn", "pos"]
    tokens = table(spark, d, "conversations").select(
        "conv_id", "turn", F.posexplode(P.word_tokens("text")).alias("pos", "word")
    )
    return running_count(tokens, ["word"], order, plan_split(tokens, ["word"], order))


def _with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.col("event_id").cast("string"))


def count_window(spark, d):
    ev = _with_text(events(spark, d))
    split = plan_split(ev, ["user_id"], ARRIVAL)
    return count_tumbling(ev, ["user_id"], ARRIVAL, 3, [joined("text", ARRIVAL, "", "ids")], split)


def count_window_slide(spark, d):
    ev = _with_text(events(spark, d))
    split = plan_split(ev, ["user_id"], ARRIVAL)
    return count_sliding(ev, ["user_id"], ARRIVAL, 3, 2, [joined("text", ARRIVAL, "", "ids")], split)


def count_window_fold(spark, d):
    ev = events(spark, d)
    hash_ = folded("event_id", ARRIVAL, F.lit(7).cast("bigint"), lambda acc, x: (acc * 31 + x) % 1000003, "hash")
    return count_tumbling(ev, ["user_id"], ARRIVAL, 4, [hash_], plan_split(ev, ["user_id"], ARRIVAL))


def reduce_concat(spark, d):
    ev = _with_text(events(spark, d)).withColumn("window_start", window_start("ts", DAY))
    split = plan_split(ev, ["user_id"], ARRIVAL)
    out = concat_in_order(
        ev, ["user_id", "window_start"], ARRIVAL, "text", "|", "ids", [total("event_id", "sum_id")], split
    )
    return plain_times(out)


def sorted_content(spark, d):
    ev = events(spark, d)
    split = plan_split(ev, ["user_id"], ["ts", *ARRIVAL])
    out = window_content(ev, ["user_id"], "ts", DAY, ARRIVAL, split)
    return plain_times(out.select("user_id", "window_start", "event_id", "position"))


def max_by_row(spark, d):
    return plain_times(R.top_rows(events(spark, d).drop("arr"), ["user_id"], "value", ["event_id"]))


def max_by_window(spark, d):
    out = tumbling(events(spark, d), ["event_type"], "ts", DAY, [top_row("value", ["event_id"], ["event_id", "value"])])
    return plain_times(out.select("event_type", "window_start", "top.*"))


def clicks_with_purchases(spark, d):
    ev = events(spark, d).select("user_id", "event_id", "event_type", "ts")
    both = interval_join(
        ev.where("event_type = 'click'"), ev.where("event_type = 'purchase'"), ["user_id"], "ts", "ts", HOUR, HOUR
    )
    return plain_times(both.select(
        F.col("l_user_id").alias("user_id"), F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"), F.col("r_ts").alias("shiptime"),
    ))


def union_filter(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return R.filtered_union(spark, orders, orders.where("o_orderstatus = 'F'"), "o_totalprice", 300_000, 400_000)


def sql_project(spark, d):
    return R.project(
        spark, table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"]
    )


def _marked(spark, d, delay_ms: int, valid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    ev = events(spark, d)
    return ev, watermark_column(ev, "ts", ARRIVAL, delay_ms, plan_split(ev, [], ARRIVAL), valid)


def watermark_bounded(spark, d):
    return plain_times(_marked(spark, d, HOUR)[1].select("event_id", "watermark"))


def watermark_punctuated(spark, d):
    return plain_times(_marked(spark, d, 0, F.col("event_type") != "error")[1].select("event_id", "watermark"))


def watermark_explicit(spark, d):
    return plain_times(_marked(spark, d, 1)[1].select("event_id", "watermark"))


def watermark_partitioned(spark, d):
    """Four source partitions; the slowest holds the watermark back."""
    ev = events(spark, d).withColumn("part", F.col("user_id") % 4)
    out = partitioned_watermark_column(ev, "ts", "part", range(4), ARRIVAL, HOUR, plan_split(ev, [], ARRIVAL))
    return plain_times(out.select("event_id", "watermark"))


def out_of_order(spark, d):
    ev = events(spark, d)
    bad = ascending_violations(ev, ["event_type"], "ts", ARRIVAL, plan_split(ev, ["event_type"], ARRIVAL))
    return plain_times(bad.select("event_id", "event_type", "ts", "seen_ts"))


def _logged():
    return [count_rows("n"), total("event_id", "sum_id"), least("ts", "min_ts"), greatest("ts", "max_ts")]


def _log(spark, d, size_ms, lateness_ms, slide_ms=None):
    ev, marked = _marked(spark, d, HOUR)
    return firing_log(
        marked, ["user_id"], "ts", ARRIVAL, size_ms, _logged(), lateness_ms, slide_ms, split=plan_split(ev, ["user_id"], ARRIVAL)
    )


def firings(spark, d):
    return plain_times(_log(spark, d, HOUR, 2 * HOUR))


def firings_sliding(spark, d):
    return plain_times(_log(spark, d, 2 * HOUR, HOUR, HOUR))


def firings_final(spark, d):
    marked = _marked(spark, d, HOUR)[1]
    return plain_times(final_firings(marked, ["user_id"], "ts", HOUR, _logged(), 2 * HOUR))


def late_side_output(spark, d):
    marked = _marked(spark, d, HOUR)[1]
    return plain_times(late_rows(marked, "ts", HOUR, 2 * HOUR).select("event_id", "user_id", "ts", "watermark"))


def _lagged(spark, d) -> DataFrame:
    """Events with a watermark two hours behind an ingest clock; the clock runs half an hour ahead of the newest time seen."""
    ev = events(spark, d)
    clock = scan(ev, [], ARRIVAL, [greatest("ts", "clock")], split=plan_split(ev, [], ARRIVAL))
    stamped = clock.withColumn("ingest", F.col("clock") + F.expr("INTERVAL '30' MINUTE"))
    return lag_watermark_column(stamped, "ingest", 2 * HOUR)


def late_by_lag(spark, d):
    return plain_times(behind_watermark(_lagged(spark, d), "ts").select("event_id", "ts", "watermark"))


def late_windows_by_lag(spark, d):
    return plain_times(late_rows(_lagged(spark, d), "ts", HOUR).select("event_id", "ts", "watermark"))


def delta_top(spark, d):
    ev = events(spark, d).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    split = plan_split(ev, ["user_id"], ["event_id"])
    time_split = plan_split(ev, ["user_id"], ["ts", "event_id"]) if split else None
    moved = scan(ev, ["user_id"], ["event_id"], [total("cents", "distance")], split=split)
    if split is not None:
        moved = staged(moved)
    out = delta_trigger_top(
        moved, ["user_id"], ["event_id"], "ts", "distance", "cents", 5000, DAY, ["event_id", "cents"], split, time_split
    )
    return plain_times(out.select(
        "user_id", F.col("event_id").alias("fire_id"), "fire_ts",
        F.col("top.event_id").alias("top_id"), F.col("top.cents").alias("top_cents"),
    ))


def map_filter(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size")
    return R.evens(R.squares(part, "p_size"), "p_size")


def arithmetic(spark, d):
    part = table(spark, d, "part")
    return part.select(
        "p_partkey",
        F.round(P.metres_per_second(F.col("p_size")), 6).alias("mps"),
        P.clamp(F.col("p_size") + 5, 0, 40).alias("faster"),
        P.clamp(F.col("p_size") - 20, 0, 40).alias("slower"),
    )


def _json_lines(df: DataFrame) -> DataFrame:
    """Car lines derived from the events: user as kind, time, and the number inside ``props``."""
    k = F.get_json_object("props", "$.k").cast("int")
    cars = df.select(*ARRIVAL, F.col("user_id").cast("string").alias("kind"), F.unix_millis("ts").alias("ms"), k.alias("k"))
    text = payload.json_payload({"carKind": "kind", "timeStamp": "ms", "carSum": "k"})
    return cars.select(*ARRIVAL, text.alias("value"))


def json_project(spark, d):
    out = P.parse(_json_lines(events(spark, d)), P.CAR_JSON_LINE, "quarantine").rows
    return out.select("event_id", "car_kind", "ts_ms", "car_sum")


def json_car_windows(spark, d):
    return plain_times(jobs.car_windows_by_arrival(_json_lines(events(spark, d)), ARRIVAL, 8 * HOUR))


def json_car_sliding(spark, d):
    return plain_times(jobs.car_sliding(_json_lines(events(spark, d)), 10 * HOUR, 5 * HOUR))


def json_car_firings(spark, d):
    log, _ = jobs.car_firings(
        _json_lines(events(spark, d)), ARRIVAL, HOUR, HOUR, 2 * HOUR, by_arrival=True, parser=P.CAR_JSON_LINE
    )
    return plain_times(log.drop("cause", *ARRIVAL))


def text_car_late(spark, d):
    ev = events(spark, d)
    cells = [F.col("event_type"), F.unix_millis("ts").cast("string"), F.col("user_id").cast("string")]
    late = jobs.car_late(_lines(ev, cells, "@"), ARRIVAL, HOUR, 30 * MINUTE, HOUR)
    return late.select("event_id", "car_kind", "ts_ms", "car_sum")


def _lines(df: DataFrame, columns: list[Column], sep: str) -> DataFrame:
    return df.select(*ARRIVAL, F.concat_ws(sep, *columns).alias("value"))


def text_car_windows(spark, d):
    ev = events(spark, d)
    lines = _lines(ev, [F.col("event_type"), F.unix_millis("ts").cast("string"), F.col("user_id").cast("string")], "@")
    out = jobs.car_windows(lines, 3 * HOUR)
    return out.select(payload.range_line("car_kind").alias("line"))


def keyed_line_windows(spark, d):
    ev = events(spark, d)
    lines = _lines(ev, [F.col("event_type"), F.unix_millis("ts").cast("string")], ",")
    return jobs.keyed_windows(lines, 3 * HOUR).select(payload.comma_line("key").alias("line"))


def counted_line_windows(spark, d):
    ev = events(spark, d)
    lines = _lines(
        ev, [F.col("event_type"), F.col("user_id").cast("string"), F.date_format("ts", COMPACT)], ","
    )
    return plain_times(jobs.counted_messages(lines, ARRIVAL, 12 * HOUR))


def telemetry_top_speed(spark, d):
    """Cars are users, speed is the number in ``props``, distance the event number; lines as a logger writes them."""
    ev = events(spark, d)
    cells = [F.col("user_id"), F.get_json_object("props", "$.k"), F.col("event_id").cast("double"), F.unix_millis("ts")]
    text = F.concat(F.lit("("), F.concat_ws(",", *[c.cast("string") for c in cells]), F.lit(")"))
    lines = ev.select("event_id", text.alias("value"))
    out = jobs.top_speed(lines, ["event_id"], threshold=200, evict_ms=2 * DAY)
    return out.select(
        "id", F.col("event_id").alias("fire_id"), F.col("top.speed").alias("speed"), F.col("top.ts_ms").alias("ts_ms")
    )


def line_parse(spark, d):
    """One event written in every line format and read back."""
    ev = events(spark, d)
    kind, user, ms = F.col("event_type"), F.col("user_id").cast("string"), F.unix_millis("ts")
    text_ms = ms.cast("string")
    number = F.col("event_id").cast("double").cast("string")
    bracketed = F.concat(F.lit("("), F.concat_ws(",", user, user, number, text_ms), F.lit(")"))
    nothing = F.lit(None).cast("string")

    def read(lines: DataFrame, parser: P.LineParser, form: str, name: Column, number: Column, at: Column) -> DataFrame:
        rows = P.parse(lines, parser, "fail").rows
        return rows.select("event_id", F.lit(form).alias("form"), name.alias("name"), number.cast("bigint").alias("number"), at.alias("at"))

    parts = [
        read(_lines(ev, [kind, text_ms, user], "@"), P.CAR_TEXT, "car", F.col("car_kind"), F.col("car_sum"), F.col("ts_ms")),
        read(_lines(ev, [kind, text_ms], ","), P.KEYED, "keyed", F.col("key"), nothing, F.col("ts_ms")),
        read(_lines(ev, [kind, user, F.date_format("ts", COMPACT)], ","), P.COUNTED, "counted", F.col("key"), F.col("n"), F.col("ts_ms")),
        read(_lines(ev, [kind, user, F.lit("x")], ","), P.PERSON, "person", F.col("name"), F.col("age"), F.lit(None).cast("bigint")),
        read(_lines(ev, [kind, user], " "), P.JOB, "job", F.col("name"), F.col("job"), F.lit(None).cast("bigint")),
        read(_lines(ev, [bracketed], ""), P.TELEMETRY, "telemetry", F.col("id").cast("string"), F.col("distance"), F.col("ts_ms")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def people_jobs(spark, d):
    ev = events(spark, d)
    people = ev.where("event_type = 'view'").select(
        "ts", F.concat_ws(",", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"), F.lit("F")).alias("value")
    )
    work = ev.where("event_type = 'purchase'").select(
        "ts", F.concat_ws(" ", F.col("user_id").cast("string"), F.concat(F.lit("job"), F.col("event_id").cast("string"))).alias("value")
    )
    return plain_times(jobs.people_with_jobs(people, work, "ts", 2 * HOUR))


def job_lines(spark, d):
    """Conversation turns read as ``name job`` lines; turns with fewer than two words come back as bad."""
    parsed = P.parse(table(spark, d, "conversations").drop("role"), P.JOB, "quarantine", value="text")
    good = parsed.rows.select("conv_id", "turn", "name", "job")
    bad = parsed.bad.select("conv_id", "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("job"))
    return good.unionByName(bad)


def person_lines(spark, d):
    rows = P.parse(table(spark, d, "documents").select("doc_id", "text"), P.PERSON, "drop", value="text").rows
    return rows.select("doc_id", F.md5("name").alias("name"), F.md5("age").alias("age"), F.md5("sexy").alias("sexy"))


def text_times(spark, d):
    orders = as_timestamp(table(spark, d, "orders"), "o_orderdate")
    ms = text_to_millis(F.date_format("o_orderdate", COMPACT)).alias("ms")
    return orders.select("o_orderkey", ms, text_to_millis("o_orderpriority").alias("bad_ms")).select(
        "*", millis_to_text("ms", SECONDS).alias("seconds_text"), millis_to_text("ms", MILLIS).alias("millis_text")
    )


def message_json(spark, d):
    ev = events(spark, d).select("event_id", F.col("event_type").alias("kind"), F.unix_millis("ts").alias("ms"), "user_id")
    return payload.json_messages(ev, {"carKind": "kind", "timeStamp": "ms", "carSum": "user_id"})


def message_lines(spark, d):
    return payload.line_messages(events(spark, d), ["event_id", "user_id", "event_type"])


def latest_rows(spark, d):
    return plain_times(R.latest_by_key(events(spark, d), ["user_id"], ARRIVAL))


def single_tokens(spark, d):
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.posexplode(P.space_tokens("text")).alias("pos", "word")
    )


QUERIES = {
    "tumble_stats": tumble_stats,
    "tumble_first_last": tumble_first_last,
    "tumble_sum_first": tumble_sum_first,
    "slide_sum": slide_sum,
    "slide_count": slide_count,
    "sum_lines": sum_lines,
    "click_lines": click_lines,
    "slide_panes": slide_panes,
    "slide_blocks": slide_blocks,
    "session_sum": session_sum,
    "ingest_window_fold": ingest_window_fold,
    "word_count": documents_word_count,
    "word_count_space": conversations_word_count,
    "window_word_count": window_word_count,
    "running_count": event_running_count,
    "running_word_count": word_running_count,
    "count_window": count_window,
    "count_window_slide": count_window_slide,
    "count_window_fold": count_window_fold,
    "reduce_concat": reduce_concat,
    "sorted_window_content": sorted_content,
    "max_by_row": max_by_row,
    "max_by_window": max_by_window,
    "interval_join": clicks_with_purchases,
    "union_filter": union_filter,
    "sql_project": sql_project,
    "watermark_column": watermark_bounded,
    "watermark_punctuated": watermark_punctuated,
    "watermark_explicit": watermark_explicit,
    "watermark_partitioned": watermark_partitioned,
    "ascending_violations": out_of_order,
    "firing_log": firings,
    "firing_log_sliding": firings_sliding,
    "firing_final": firings_final,
    "late_rows": late_side_output,
    "lag_watermark_late": late_by_lag,
    "lag_window_late": late_windows_by_lag,
    "delta_trigger_top": delta_top,
    "map_filter": map_filter,
    "arithmetic": arithmetic,
    "json_project": json_project,
    "json_car_windows": json_car_windows,
    "json_car_sliding": json_car_sliding,
    "json_car_firings": json_car_firings,
    "text_car_late": text_car_late,
    "text_car_windows": text_car_windows,
    "keyed_line_windows": keyed_line_windows,
    "counted_line_windows": counted_line_windows,
    "telemetry_top_speed": telemetry_top_speed,
    "line_parse": line_parse,
    "people_jobs_join": people_jobs,
    "job_lines": job_lines,
    "person_lines": person_lines,
    "text_times": text_times,
    "message_json": message_json,
    "message_lines": message_lines,
    "latest_by_key": latest_rows,
    "space_tokens": single_tokens,
}
