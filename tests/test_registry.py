"""Every registered query against its SQL in DuckDB, and plan checks over all of them."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, canonical
from touchline import registry

SF = "/root/testdata/sf0.001"
PYTHON_STEPS = {"throttle_events", "raw_tree_scan", "page_league_rows", "page_scorer_rows", "page_expected_goals", "page_tables"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in PYTHON_STEPS:
        assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", plan)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(registry.ORACLES[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == canonical(columns, rel.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry_holds_every_library_query():
    assert registry.QUERIES.items() <= entry.queries().items()
    assert registry.ORACLES.items() <= entry.oracle_sql().items()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
