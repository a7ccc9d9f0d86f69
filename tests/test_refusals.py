"""Inputs that are refused, cast, or read with care."""

import json

import pytest
from pyspark.sql import functions as F

from touchline.constants import ADHOC_TABLES
from touchline.operators import ranking, scans
from touchline.plans import adhoc, search, staging
from touchline.sources import files, pages


def test_limits_above_the_maximum_are_refused(spark):
    df = spark.range(80)
    assert ranking.top_n(df, [F.col("id")], 50, 50).count() == 50
    for limit in (0, 51):
        with pytest.raises(ValueError):
            ranking.top_n(df, [F.col("id")], limit, 50)


def test_positions_of_teams_without_a_match(spark):
    df = spark.createDataFrame([("L", k, 0) for k in range(200)], "league string, team int, points int")
    got = scans.rank_within(df, ["league"], [*scans.falling("points"), F.col("team")], places=6)
    assert sorted((r.team, r.position) for r in got.collect()) == [(k, k + 1) for k in range(200)]


@pytest.fixture
def marts(spark):
    spark.range(3).createOrReplaceTempView("hidden_view")
    spark.createDataFrame([(7,)], "id int").createOrReplaceGlobalTempView("shared_view")
    mart = spark.sql("SELECT 1 AS id, timestamp'2024-01-02' AS utc_date, 'FROM home' AS s")
    yield {name: mart for name in ADHOC_TABLES}
    spark.catalog.dropTempView("hidden_view")
    spark.catalog.dropGlobalTempView("shared_view")


@pytest.mark.parametrize("statement", [
    "SELECT h.id FROM gold.{t} m, hidden_view h",
    "SELECT m.id FROM gold.{t} m, parquet.`/root/testdata/sf0.001/nation.parquet` p",
    "SELECT * FROM gold.{t} WHERE id IN (SELECT id FROM hidden_view)",
    "SELECT (SELECT max(id) FROM hidden_view) AS x FROM gold.{t}",
    "WITH hidden_view AS (SELECT id FROM gold.{t}) SELECT * FROM hidden_view",
    "SELECT * FROM gold.{t} m, IDENTIFIER('hidden_view') h",
    "SELECT * FROM gold.{t} m, IDENTIFIER('hidden' || '_view') h",
    "SELECT * FROM gold.{t} m, global_temp.shared_view h",
    "SELECT java_method('java.lang.System', 'getenv', 'PATH') FROM gold.{t}",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home') FROM gold.{t}",
    "SELECT * FROM gold.{t} WHERE try_reflect('java.lang.System', 'getProperty', 'user.home') IS NULL",
    "SELECT TRANSFORM(id) USING 'cat' AS (x) FROM gold.{t}",
    "SELECT input_file_name() FROM gold.{t}",
    "SELECT current_user() FROM gold.{t}",
    "SELECT m.id FROM gold.{t} m, range(5) r",
    "SELECT id FROM gold.{t} UNION ALL SELECT * FROM VALUES (1)",
    "SELECT nowhere FROM gold.{t}",
])
def test_adhoc_refuses_other_relations(spark, marts, statement):
    with pytest.raises(adhoc.RefusedStatement):
        adhoc.run_readonly(spark, marts, statement.format(t=ADHOC_TABLES[0]))


@pytest.mark.parametrize("statement", [
    "SELECT extract(YEAR FROM utc_date) AS y, 'x FROM gold.{t}' AS z FROM gold.{t}",
    "SELECT s FROM gold.{t} WHERE s = 'FROM home'",
    "WITH a AS (SELECT * FROM gold.{t}) SELECT id FROM a",
    "SELECT count(*) AS n, round(avg(id), 2) AS a, max(utc_date) AS m FROM gold.{t} GROUP BY s HAVING count(*) >= 1 ORDER BY n DESC NULLS LAST",
    "SELECT id, row_number() OVER (PARTITION BY s ORDER BY utc_date DESC) AS r, lag(id, 1) OVER (ORDER BY id) AS l FROM gold.{t}",
    "SELECT DISTINCT a.id FROM gold.{t} a LEFT JOIN gold.{t} b ON a.id = b.id WHERE a.id IN (SELECT id FROM gold.{t}) AND EXISTS (SELECT 1 FROM gold.{t} c WHERE c.id = a.id)",
    "SELECT CASE WHEN id BETWEEN 0 AND 5 THEN upper(s) ELSE 'x' END AS u, coalesce(nullif(s, ''), '-') AS c, cast(id AS string) || s AS k FROM gold.{t} WHERE s ILIKE '%home%' AND date_trunc('month', utc_date) <= current_date()",
    "SELECT id FROM gold.{t} UNION SELECT id FROM gold.{t}",
    "SELECT string_agg(s, ',') WITHIN GROUP (ORDER BY id) AS j, count(DISTINCT id) AS d, sum(CASE WHEN id > 0 THEN 1 ELSE 0 END) AS p FROM gold.{t}",
])
def test_adhoc_runs_over_marts(spark, marts, statement):
    assert adhoc.run_readonly(spark, marts, statement.format(t=ADHOC_TABLES[0])).count() == 1


def _bronze(spark, match):
    payload = json.dumps({"matches": [match]})
    row = ("football_data_org", "matches", "1", payload, None, "h", None, "2024", "PL")
    from touchline import schemas
    return spark.createDataFrame([row], schemas.BRONZE)


def test_numbers_as_text_are_cast_and_bad_ones_raise(spark):
    match = {"id": "12", "matchday": "7", "status": "FINISHED", "utcDate": "2024-01-01T10:00:00Z", "homeTeam": {"id": 1}, "awayTeam": {"id": "2"},
             "score": {"fullTime": {"home": "3", "away": 0}}}
    row = staging.primary_matches(_bronze(spark, match)).first()
    assert (row.source_match_id, row.matchday, row.away_team_id, row.home_score, row.away_score) == (12, 7, 2, 3, 0)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.primary_matches(_bronze(spark, match | {"matchday": "x"})).collect()


def test_first_table_body_only(spark):
    page = "<table><tbody><tr><td>1</td></tr></tbody><tbody><tr><td>2</td></tr></tbody></table>"
    rows = pages.table_cells(spark.createDataFrame([(1, page)], "id int, html string")).collect()
    assert [[c["text"] for c in r.cells] for r in rows] == [["1"]]


def test_paths_are_anchored_on_the_whole_root(spark, tmp_path):
    root = tmp_path / "raw" / "proj" / "raw"
    folder = root / "source" / "matches" / "2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("{}")
    found, short = files.discover_files(spark, str(root))
    assert [r.source for r in found.collect()] == ["source"] and short.count() == 0


def test_search_text_rules(spark):
    queries = spark.createDataFrame([("\tgunners\n",), ("a",), ("  ",)], "query string")
    aliases = spark.createDataFrame([("team", "gunners", 1)], "entity_type string, alias string, entity_id int")
    entities = spark.createDataFrame([(1, "Arsenal", "PL"), (2, "Aston", "PL")], "id int, name string, subtitle string")
    got = search.search_entities(queries, aliases, entities, "team").collect()
    assert [(r["query"], r["id"]) for r in got] == [("\tgunners\n", 1)]
