"""Shape of the physical plans: shuffles, joins, pruning, and no row-at-a-time Python."""

import re

import pytest

from tidemark.operators.scan import HOT_ROWS_SETTING
from tidemark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_multiplies_rows_or_runs_row_udfs(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text
    # The only data that meets in one task is one row per range of a scan over all rows.
    for block in re.findall(r"Exchange SinglePartition.*\n(.*)\n", text):
        assert "HashAggregate(keys=[_bucket" in block


@pytest.mark.parametrize("name", ["session_sum", "running_count", "count_window_slide", "reduce_concat", "firing_log", "delta_trigger_top"])
def test_hot_key_plans_have_no_large_single_task(spark, name):
    spark.conf.set(HOT_ROWS_SETTING, "10")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
    assert "_bucket" in text
    # Windows that sort rows do so per range; windows over a whole key only see range totals or range edges.
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", text)
    assert len(windows) >= 2 or name == "reduce_concat"
    for keys, order in windows:
        assert "_bucket" in keys or "_bucket" in order


@pytest.mark.parametrize("name,shuffles", [
    ("tumble_stats", 1), ("tumble_first_last", 1), ("slide_sum", 1), ("slide_panes", 2), ("session_sum", 1),
    ("word_count", 1), ("running_count", 1), ("count_window", 1), ("count_window_slide", 1), ("reduce_concat", 1),
    ("sorted_window_content", 1), ("max_by_row", 1), ("max_by_window", 1), ("latest_by_key", 1), ("delta_trigger_top", 3),
    ("watermark_column", 2), ("firing_log", 4), ("firing_final", 3), ("union_filter", 0), ("map_filter", 0), ("line_parse", 0),
])
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange hashpartitioning", plan(spark, name))) == shuffles


def test_scans_read_what_is_used(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(spark, "tumble_stats")
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "value"}
    text = plan(spark, "interval_join")
    assert "EqualTo(event_type,click)" in text and "EqualTo(event_type,purchase)" in text
    text = plan(spark, "union_filter")
    assert "GreaterThan(o_totalprice,300000.0)" in text and "LessThan(o_totalprice,400000.0)" in text
