"""The queries of the package that have SQL, against DuckDB over the whole small tables."""

import glob
import math
import os

import duckdb
import pytest

from tidemark.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-len('.parquet')]} AS SELECT * FROM '{path}'")
    got = LLM_QUERIES[name](spark, SF_DIR)
    want = duck.execute(LLM_ORACLES[name])
    kinds = {c[0]: KINDS[str(c[1])] for c in want.description}
    assert {f.name: f.dataType.simpleString() for f in got.schema} == kinds
    names = sorted(kinds)
    at = [[c[0] for c in want.description].index(n) for n in names]
    rows = sorted(tuple(r[n] for n in names) for r in got.collect())
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)
    assert rows == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_oracles_belong_to_queries():
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)
