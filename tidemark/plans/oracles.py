"""The registered queries in plain SQL, one statement per query, for an engine that reads the same parquet tables."""

from __future__ import annotations

EVENTS = "ev AS (SELECT *, event_id + (event_id * 37) % 101 AS arr FROM events)"


def bucket(width: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01')"


def _windows(width: str, select: str, keys: str = "user_id", source: str = "ev") -> str:
    return f"""
    WITH {EVENTS}, w AS (SELECT *, {bucket(width)} AS window_start FROM {source})
    SELECT {keys}, window_start, window_start + INTERVAL '{width}' AS window_end, {select}
    FROM w GROUP BY {keys}, window_start"""


def _sliding(size_hours: int, slide_hours: int, select: str) -> str:
    return f"""
    WITH {EVENTS}, w AS (
      SELECT ev.*, {bucket(f'{slide_hours} hours')} - to_hours({slide_hours} * i) AS window_start
      FROM ev, range({size_hours // slide_hours}) t(i))
    SELECT user_id, window_start, window_start + INTERVAL '{size_hours} hours' AS window_end, {select}
    FROM w GROUP BY user_id, window_start"""


def _watermark(delay_us: int, seen: str = "epoch_us(ts)") -> str:
    return f"""
    WITH {EVENTS}, m AS (
      SELECT event_id, max({seen}) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
      FROM ev)
    SELECT event_id, make_timestamp(high - {delay_us}) AS watermark FROM m"""


def _partitioned_watermark(delay_us: int, partitions: int) -> str:
    highs = ", ".join(
        f"max(CASE WHEN user_id % {partitions} = {i} THEN epoch_us(ts) END) OVER w AS h{i}" for i in range(partitions))
    names = [f"h{i}" for i in range(partitions)]
    return f"""
    WITH {EVENTS}, m AS (
      SELECT event_id, {highs} FROM ev
      WINDOW w AS (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, CASE WHEN {" AND ".join(f"{n} IS NOT NULL" for n in names)}
      THEN make_timestamp(least({", ".join(names)}) - {delay_us}) END AS watermark FROM m"""


HOUR_US = 3_600_000_000

MARKED = f"""{EVENTS}, marked AS (
      SELECT *, max(epoch_us(ts)) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {HOUR_US} AS wm
      FROM ev)"""


LAGGED = f"""{EVENTS}, c AS (
      SELECT event_id, ts, max(ts) OVER (ORDER BY arr, event_id ROWS UNBOUNDED PRECEDING)
        + INTERVAL '30 minutes' - INTERVAL '2 hours' AS watermark FROM ev)"""


def _log(size_h: int, slide_h: int, lateness_h: int) -> str:
    return f"""{MARKED}, w AS (
      SELECT *, {bucket(f'{slide_h} hours')} - to_hours({slide_h} * i) AS window_start
      FROM marked, range({size_h // slide_h}) t(i)),
    placed AS (
      SELECT *, epoch_us(window_start) + {size_h * HOUR_US} - 1000 AS edge FROM w),
    classed AS (
      SELECT *, CASE WHEN wm IS NULL OR wm < edge THEN 0 WHEN wm < edge + {lateness_h * HOUR_US} THEN 1 ELSE 2 END AS cls
      FROM placed),
    steps AS (
      SELECT user_id, window_start, 'on_time' AS cause, NULL::BIGINT AS arr, NULL::BIGINT AS event_id, count(*) AS n1,
             sum(event_id) AS s1, min(ts) AS lo, max(ts) AS hi
      FROM classed WHERE cls = 0 GROUP BY ALL
      UNION ALL
      SELECT user_id, window_start, 'again', arr, event_id, 1, event_id, ts, ts FROM classed WHERE cls = 1),
    log AS (
      SELECT user_id, window_start, window_start + INTERVAL '{size_h} hours' AS window_end,
             row_number() OVER f AS firing, cause, arr, event_id,
             CAST(sum(n1) OVER f AS BIGINT) AS n, CAST(sum(s1) OVER f AS BIGINT) AS sum_id,
             min(lo) OVER f AS min_ts, max(hi) OVER f AS max_ts
      FROM steps
      WINDOW f AS (PARTITION BY user_id, window_start ORDER BY arr NULLS FIRST, event_id NULLS FIRST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _numbered(key: str = "user_id") -> str:
    return f"""{EVENTS}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY arr, event_id) AS rn FROM ev)"""


def _java_split(text: str, sep: str) -> str:
    """Parts without trailing empty ones."""
    stripped = f"regexp_replace({text}, '(?:{sep})+\\z', '')"
    return f"CASE WHEN {stripped} <> '' OR {text} = '' THEN string_split_regex({stripped}, '{sep}') ELSE [] END"


WORDS = r"[w FOR w IN string_split_regex(lower({0}), '\W+') IF w <> '']"
SPACES = _java_split("text", " ")
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
T_SEC, T_MS = "'%Y-%m-%d %H:%M:%S'", "'%Y-%m-%d %H:%M:%S.%g'"


def _delta(measure: str, by: str, threshold: int, evict: str) -> str:
    return f"""
    {EVENTS}, cars AS (
      SELECT user_id, event_id, ts, {K} AS k, CAST(round(value * 100) AS BIGINT) AS cents FROM ev),
    moved AS (
      SELECT *, {measure} AS distance, {by} AS speed,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM cars),
    fires AS (
      SELECT user_id, event_id, ts, distance, rn FROM moved WHERE rn = 1
      UNION ALL
      SELECT m.user_id, m.event_id, m.ts, m.distance, m.rn
      FROM fires f, LATERAL (
        SELECT x.* FROM moved x WHERE x.user_id = f.user_id AND x.rn > f.rn AND x.distance - f.distance > {threshold}
        ORDER BY x.rn LIMIT 1) m),
    found AS (
      SELECT f.user_id, f.event_id AS fire_id, f.ts AS fire_ts,
             arg_max(struct_pack(id := m.event_id, speed := m.speed, ts := m.ts), (m.speed, -m.event_id)) AS top
      FROM fires f JOIN moved m ON m.user_id = f.user_id AND m.rn <= f.rn AND m.ts > f.ts - INTERVAL '{evict}'
      WHERE f.rn > 1 GROUP BY f.user_id, f.event_id, f.ts)"""


ORACLES = {
    "tumble_stats": _windows("1 day", "count(*) AS n, min(ts) AS min_ts, max(ts) AS max_ts, round(sum(value), 4) AS sum_value"),
    "tumble_first_last": _windows(
        "1 day", "count(*) AS n, arg_min(ts, (arr, event_id)) AS first_ts, arg_max(ts, (arr, event_id)) AS last_ts, "
        "round(sum(value), 4) AS sum_value"),
    "tumble_sum_first": _windows(
        "6 hours", "CAST(sum(event_id) AS BIGINT) AS sum_id, arg_min(event_type, (arr, event_id)) AS event_type"),
    "slide_sum": _sliding(2, 1, "round(sum(value), 4) AS sum_value"),
    "slide_count": _sliding(2, 1, "count(*) AS n"),
    "sum_lines": f"""
    WITH {EVENTS}, w AS (
      SELECT user_id, event_id, ts, {bucket('4 hours')} - to_hours(4 * i) AS window_start FROM ev, range(3) t(i))
    SELECT user_id, epoch_ms(window_start) AS start_ms, 'key:' || user_id || '    carSum:  ' || CAST(sum(event_id) AS BIGINT) AS line
    FROM w WHERE ts < window_start + INTERVAL '10 hours' GROUP BY user_id, window_start""",
    "click_lines": f"""
    WITH {EVENTS}, w AS (
      SELECT event_type, {bucket('1 hours')} - to_hours(i) AS window_start FROM ev, range(2) t(i))
    SELECT event_type, epoch_ms(window_start) AS start_ms, 'clickNum:' || count(*) AS line FROM w GROUP BY event_type, window_start""",
    "slide_panes": _sliding(24, 2, "count(*) AS n, min(ts) AS min_ts, arg_max(event_id, (arr, event_id)) AS last_id"),
    "slide_blocks": f"""
    WITH {EVENTS}, w AS (
      SELECT ev.*, {bucket('10 minutes')} - to_minutes(10 * i) AS window_start FROM ev, range(144) t(i))
    SELECT event_type, window_start, window_start + INTERVAL '24 hours' AS window_end, count(*) AS n, min(ts) AS min_ts,
           arg_max(event_id, (arr, event_id)) AS last_id, CAST(sum(user_id) AS BIGINT) AS sum_user
    FROM w GROUP BY event_type, window_start""",
    "session_sum": f"""
    WITH {EVENTS}, g AS (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '6 hours' THEN 0 ELSE 1 END AS o
      FROM ev),
    s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '6 hours' AS window_end, count(*) AS n,
           round(sum(value), 4) AS sum_value, arg_min(event_type, (arr, event_id)) AS event_type
    FROM s GROUP BY user_id, sid""",
    "ingest_window_fold": f"""
    SELECT user_id AS "user", {bucket('12 hours')} AS window_start,
           {bucket('12 hours')} + INTERVAL '12 hours' AS window_end, CAST(sum(event_id) AS BIGINT) AS bytes
    FROM events GROUP BY ALL""",
    "word_count": f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({WORDS.format('text')}) AS word FROM documents) GROUP BY word""",
    "word_count_space": f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({SPACES}) AS word FROM conversations) GROUP BY word""",
    "window_word_count": f"""
    WITH w AS (SELECT unnest({WORDS.format('props')}) AS word, {bucket('1 day')} AS window_start FROM events)
    SELECT word, window_start, window_start + INTERVAL '1 day' AS window_end, count(*) AS n FROM w GROUP BY ALL""",
    "running_count": f"""
    WITH {EVENTS}
    SELECT event_id, event_type,
           count(*) OVER (PARTITION BY event_type ORDER BY arr, event_id ROWS UNBOUNDED PRECEDING) AS running_n
    FROM ev""",
    "running_word_count": f"""
    WITH t AS (SELECT conv_id, turn, {WORDS.format('text')} AS ws FROM conversations),
    p AS (SELECT conv_id, turn, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos FROM t)
    SELECT *, count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, pos ROWS UNBOUNDED PRECEDING) AS running_n FROM p""",
    "count_window": f"""
    WITH {_numbered()}
    SELECT user_id, (rn - 1) // 3 + 1 AS window_no, string_agg(event_id::VARCHAR, '' ORDER BY rn) AS ids
    FROM numbered GROUP BY ALL HAVING count(*) = 3""",
    "count_window_slide": f"""
    WITH {_numbered()}, f AS (
      SELECT user_id, rn, list(event_id::VARCHAR) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS l
      FROM numbered)
    SELECT user_id, rn // 2 AS window_no, array_to_string(l, '') AS ids FROM f WHERE rn % 2 = 0""",
    "count_window_fold": f"""
    WITH {_numbered()}, g AS (
      SELECT user_id, (rn - 1) // 4 + 1 AS window_no, list(event_id ORDER BY rn) AS l FROM numbered GROUP BY ALL HAVING count(*) = 4)
    SELECT user_id, window_no,
           (((((((7 * 31 + l[1]) % 1000003) * 31 + l[2]) % 1000003) * 31 + l[3]) % 1000003) * 31 + l[4]) % 1000003 AS hash
    FROM g""",
    "reduce_concat": f"""
    WITH {EVENTS}
    SELECT user_id, {bucket('1 day')} AS window_start, string_agg(event_id::VARCHAR, '|' ORDER BY arr, event_id) AS ids,
           CAST(sum(event_id) AS BIGINT) AS sum_id
    FROM ev GROUP BY ALL""",
    "sorted_window_content": f"""
    WITH {EVENTS}
    SELECT user_id, {bucket('1 day')} AS window_start, event_id,
           row_number() OVER (PARTITION BY user_id, {bucket('1 day')} ORDER BY ts, arr, event_id) AS position
    FROM ev""",
    "max_by_row": """
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1""",
    "max_by_window": f"""
    SELECT event_type, {bucket('1 day')} AS window_start, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, {bucket('1 day')} ORDER BY value DESC, event_id) = 1""",
    "interval_join": """
    SELECT c.user_id, c.event_id AS click_id, p.event_id AS purchase_id, p.ts AS shiptime
    FROM events c JOIN events p ON c.user_id = p.user_id
      AND c.ts BETWEEN p.ts - INTERVAL '1 hour' AND p.ts + INTERVAL '1 hour'
    WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
    "union_filter": """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 300000
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 400000""",
    "sql_project": "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders",
    "watermark_column": _watermark(HOUR_US),
    "watermark_partitioned": _partitioned_watermark(HOUR_US, 4),
    "watermark_punctuated": _watermark(0, "CASE WHEN event_type <> 'error' THEN epoch_us(ts) END"),
    "watermark_explicit": _watermark(1000),
    "ascending_violations": f"""
    WITH {EVENTS}, s AS (
      SELECT event_id, event_type, ts, max(ts) OVER (
        PARTITION BY event_type ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_ts FROM ev)
    SELECT * FROM s WHERE ts < seen_ts""",
    "firing_log": f"WITH {_log(1, 1, 2)} SELECT * FROM log",
    "firing_log_sliding": f"WITH {_log(2, 1, 1)} SELECT * FROM log",
    "firing_final": f"""
    WITH {_log(1, 1, 2)}
    SELECT user_id, window_start, window_end, firing, n, sum_id, min_ts, max_ts FROM log
    QUALIFY row_number() OVER (PARTITION BY user_id, window_start ORDER BY firing DESC) = 1""",
    "late_rows": f"""
    WITH {MARKED}
    SELECT event_id, user_id, ts, make_timestamp(wm) AS watermark FROM marked
    WHERE wm >= epoch_us({bucket('1 hour')}) + {HOUR_US} - 1000 + {2 * HOUR_US}""",
    "lag_watermark_late": f"WITH {LAGGED} SELECT * FROM c WHERE ts <= watermark",
    "lag_window_late": f"""
    WITH {LAGGED} SELECT * FROM c WHERE epoch_us(watermark) >= epoch_us({bucket('1 hour')}) + {HOUR_US} - 1000""",
    "delta_trigger_top": "WITH RECURSIVE " + _delta(
        "sum(cents) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)", "cents", 5000, "1 day")
    + " SELECT user_id, fire_id, fire_ts, top.id AS top_id, top.speed AS top_cents FROM found",
    "map_filter": """
    SELECT p_partkey, p_size, CAST(p_size AS BIGINT) * p_size AS square FROM part WHERE p_size % 2 = 0""",
    "arithmetic": """
    SELECT p_partkey, round(p_size / 3.6::DOUBLE, 6) AS mps, greatest(0, least(40, p_size + 5)) AS faster,
           greatest(0, least(40, p_size - 20)) AS slower FROM part""",
    "json_project": f"""
    SELECT event_id, CAST(user_id AS VARCHAR) AS car_kind, (epoch_us(ts) // 1000) AS ts_ms, {K} AS car_sum FROM events""",
    "json_car_windows": f"""
    WITH {EVENTS}, w AS (SELECT *, {bucket('8 hours')} AS window_start, make_timestamp_ms((epoch_us(ts) // 1000)) AS tms FROM ev)
    SELECT CAST(user_id AS VARCHAR) AS car_kind, window_start, window_start + INTERVAL '8 hours' AS window_end, count(*) AS n,
           arg_min(tms, (arr, event_id)) AS first_ts, arg_max(tms, (arr, event_id)) AS last_ts,
           CAST(sum({K}) AS BIGINT) AS total
    FROM w GROUP BY user_id, window_start""",
    "json_car_sliding": f"""
    WITH w AS (SELECT *, {bucket('5 hours')} - to_hours(5 * i) AS window_start FROM events, range(2) t(i))
    SELECT CAST(user_id AS VARCHAR) AS car_kind, window_start, window_start + INTERVAL '10 hours' AS window_end,
           CAST(sum({K}) AS BIGINT) AS total, count(*) AS n
    FROM w GROUP BY user_id, window_start""",
    "json_car_firings": f"""
    WITH {EVENTS}, cars AS (
      SELECT CAST(user_id AS VARCHAR) AS car_kind, epoch_us(ts) // 1000 AS ms, {K} AS k, arr, event_id FROM ev),
    marked AS (
      SELECT *, (ms // 3600000 + 1) * 3600000 AS e, max(ms) OVER (
        ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000 AS wm FROM cars),
    classed AS (
      SELECT *, CASE WHEN wm IS NULL OR wm < e - 1 THEN 0 WHEN wm < e - 1 + 7200000 THEN 1 ELSE 2 END AS cls FROM marked),
    steps AS (
      SELECT car_kind, e, NULL::BIGINT AS arr, NULL::BIGINT AS event_id, count(*) AS n1, sum(k) AS s1,
             arg_min(ms, (arr, event_id)) AS f1, arg_max(ms, (arr, event_id)) AS l1
      FROM classed WHERE cls = 0 GROUP BY car_kind, e
      UNION ALL
      SELECT car_kind, e, arr, event_id, 1, k, ms, ms FROM classed WHERE cls = 1)
    SELECT car_kind, make_timestamp_ms(e - 3600000) AS window_start, make_timestamp_ms(e) AS window_end,
           row_number() OVER f AS firing, CAST(sum(n1) OVER f AS BIGINT) AS n,
           make_timestamp_ms(first_value(f1) OVER f) AS first_ts, make_timestamp_ms(last_value(l1) OVER f) AS last_ts,
           CAST(sum(s1) OVER f AS BIGINT) AS total
    FROM steps
    WINDOW f AS (PARTITION BY car_kind, e ORDER BY arr NULLS FIRST, event_id NULLS FIRST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "text_car_late": f"""
    WITH {EVENTS}, marked AS (
      SELECT *, epoch_us(ts) // 1000 AS ms, max(epoch_us(ts) // 1000) OVER (
        ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1800000 AS wm FROM ev)
    SELECT event_id, event_type AS car_kind, ms AS ts_ms, CAST(user_id AS INTEGER) AS car_sum FROM marked
    WHERE wm >= (ms // 3600000 + 1) * 3600000 - 1 + 3600000""",
    "text_car_windows": f"""
    WITH w AS (SELECT *, {bucket('3 hours')} AS window_start FROM events)
    SELECT 'key:' || event_type || ',  window:[ ' || strftime(window_start, {T_SEC}) || '  ,  '
      || strftime(window_start + INTERVAL '3 hours', {T_SEC}) || ' ), elements count:' || count(*)
      || ', elements time range:[ ' || strftime(min(ts), {T_SEC}) || '  ,  ' || strftime(max(ts), {T_SEC}) || ' ]|||'
      || CAST(sum(user_id) AS BIGINT) AS line
    FROM w GROUP BY event_type, window_start""",
    "keyed_line_windows": f"""
    WITH w AS (SELECT *, {bucket('3 hours')} AS window_start FROM events)
    SELECT '(' || event_type || '),' || count(*) || ',' || strftime(min(ts), {T_MS}) || ',' || strftime(max(ts), {T_MS})
      || ',' || strftime(window_start, {T_MS}) || ',' || strftime(window_start + INTERVAL '3 hours', {T_MS}) AS line
    FROM w GROUP BY event_type, window_start""",
    "counted_line_windows": f"""
    WITH {EVENTS}
    SELECT event_type AS key, {bucket('12 hours')} AS window_start,
           string_agg(strftime(ts, '%Y%m%d-%H%M%S'), '|' ORDER BY arr, event_id) AS times,
           CAST(sum(user_id) AS BIGINT) AS total
    FROM ev GROUP BY ALL""",
    "telemetry_top_speed": "WITH RECURSIVE " + _delta("event_id", "k", 200, "2 days")
    + " SELECT CAST(user_id AS INTEGER) AS id, fire_id, top.speed AS speed, (epoch_us(top.ts) // 1000) AS ts_ms FROM found",
    "line_parse": """
    WITH e AS (SELECT event_id, event_type AS k, user_id AS u, epoch_us(ts) // 1000 AS ms FROM events)
    SELECT event_id, 'car' AS form, k AS name, u AS number, ms AS at FROM e
    UNION ALL SELECT event_id, 'keyed', k, NULL, ms FROM e
    UNION ALL SELECT event_id, 'counted', k, u, ms // 1000 * 1000 FROM e
    UNION ALL SELECT event_id, 'person', k, u, NULL FROM e
    UNION ALL SELECT event_id, 'job', k, u, NULL FROM e
    UNION ALL SELECT event_id, 'telemetry', CAST(u AS VARCHAR), event_id, ms FROM e""",
    "people_jobs_join": f"""
    SELECT CAST(v.user_id AS VARCHAR) AS name, CAST({K.replace('props', 'v.props')} AS VARCHAR) AS age, 'F' AS sexy,
           'job' || p.event_id AS job, p.ts AS shiptime
    FROM events v JOIN events p ON v.user_id = p.user_id
      AND v.ts BETWEEN p.ts - INTERVAL '2 hours' AND p.ts + INTERVAL '2 hours'
    WHERE v.event_type = 'view' AND p.event_type = 'purchase'""",
    "job_lines": f"""
    WITH t AS (SELECT conv_id, turn, {_java_split('text', '[ \\t\\n\\x0B\\f\\r]')} AS p FROM conversations)
    SELECT conv_id, turn, CASE WHEN len(p) >= 2 THEN p[1] END AS name, CASE WHEN len(p) >= 2 THEN p[2] END AS job FROM t""",
    "person_lines": f"""
    WITH t AS (SELECT doc_id, {_java_split('text', ',')} AS p FROM documents)
    SELECT doc_id, md5(p[1]) AS name, md5(p[2]) AS age, md5(p[3]) AS sexy FROM t WHERE len(p) >= 3""",
    "text_times": f"""
    SELECT o_orderkey, (epoch_us(o_orderdate) // 1000) AS ms, CAST(0 AS BIGINT) AS bad_ms,
           strftime(o_orderdate, {T_SEC}) AS seconds_text, strftime(o_orderdate, {T_MS}) AS millis_text
    FROM orders""",
    "message_json": """
    WITH m AS (SELECT '{"carKind":"' || event_type || '","timeStamp":' || (epoch_us(ts) // 1000) || ',"carSum":' || user_id || '}' AS j FROM events)
    SELECT j AS key, j AS value FROM m""",
    "message_lines": "SELECT concat_ws(',', event_id, user_id, event_type) AS value FROM events",
    "latest_by_key": f"""
    WITH {EVENTS}
    SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY arr DESC, event_id DESC) = 1""",
    "space_tokens": f"""
    WITH t AS (SELECT conv_id, turn, {SPACES} AS ws FROM conversations)
    SELECT conv_id, turn, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos, unnest(ws) AS word FROM t""",
}
