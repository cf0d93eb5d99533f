"""Every registered query against its SQL on DuckDB, over the whole small tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidemark.operators.scan import HOT_ROWS_SETTING
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

# Queries whose plan depends on whether a key is hot.
KEYED = [
    "session_sum", "running_count", "running_word_count", "count_window", "count_window_slide", "count_window_fold",
    "reduce_concat", "sorted_window_content", "ascending_violations", "firing_log", "firing_log_sliding", "firing_final",
    "delta_trigger_top", "counted_line_windows", "telemetry_top_speed", "json_car_firings", "text_car_late",
]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def canonical(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(r[i])) for i in at) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize("name", KEYED)
def test_query_with_hot_keys(spark, duck, name):
    """The same with nearly every key treated as too hot for one task."""
    spark.conf.set(HOT_ROWS_SETTING, "60")
    try:
        check(spark, duck, name)
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)


def check(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = duck.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    want_types = {c[0]: str(c[1]) for c in cur.description}
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
    for f in df.schema:
        assert kinds[want_types[f.name]] == f.dataType.simpleString(), f.name
    got = canonical(df.columns, df.collect())
    want = canonical(columns, cur.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
