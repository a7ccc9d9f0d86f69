"""Registered text queries against their SQL, and the pipeline's stages."""

import os

import duckdb
import pytest

from touchline.llm import queries

SF = "/root/testdata/sf0.001"
#: Queries that do not return one row per document or page.
OWN_ROWS = {"op12_best_positions", "op13_filter_audit"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect())))
    if name not in OWN_ROWS:
        source = "pages" if name in ("op1_html_text", "op11_warc") else "documents"
        assert len(rows) == con.execute(f"SELECT count(*) FROM {source}").fetchall()[0][0]
    if name in queries.ORACLES:
        want = con.execute(queries.ORACLES[name])
        at = [[d[0] for d in want.description].index(c) for c in columns]
        assert rows == sorted(str(tuple(r[k] for k in at)) for r in want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        before = spark.createDataFrame(after.collect(), docs.schema)
    assert 0 < before.count()
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()
    assert len(last) == before.count() and all(r.exact for r in last)
    assert corpus_pipeline.run(spark, SF).count() == len(last)
