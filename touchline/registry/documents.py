"""JSON documents and HTML pages (J1-J8, S4, S5, S7, S8, S17, E1-E4, R14), each built from table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import PRIMARY, SECONDARY, TERTIARY
from touchline.functions.json import canonical_hash, json_field, rows_as_json
from touchline.plans import adhoc, gold, silver, staging
from touchline.registry.base import SQL_MATCHES, SQL_TEAMS, matches, query, table, teams
from touchline.sources import pages
from touchline.sources.bronze import new_records, outcome_counts
from touchline.sources.files import parse_documents

_YEAR_SEASON = "concat(year(l_shipdate), '-', year(l_shipdate) + 1)"


def _bronze(rows: DataFrame, source: str, entity: str, payload: str, season: str, league: str, loaded: str) -> DataFrame:
    """Documents in the bronze layout from row expressions, beside one document of another entity."""
    docs = rows.select(
        F.lit(source).alias("source"),
        F.explode(F.array(
            F.struct(F.lit(entity).alias("entity_type"), F.expr(payload).alias("payload")),
            F.struct(F.lit("other").alias("entity_type"), F.lit('{"x": 1}').alias("payload")),
        )).alias("d"),
        F.expr(season).alias("season"), F.expr(league).alias("league"), F.expr(loaded).alias("ingestion_time"),
    )
    return docs.select("source", "d.*", "season", "league", "ingestion_time")


def _comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double, so both sides compare one type."""
    wide = {"int": "bigint"}
    return df.withColumns({
        c: F.col(c).cast("double" if t.startswith("decimal") else wide[t])
        for c, t in df.dtypes if t in wide or t.startswith("decimal")
    })


@query("stage_matches", """WITH s AS (SELECT *, CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) + 1 AS VARCHAR) AS season FROM lineitem)
    SELECT season, l_returnflag AS league, l_shipdate AS ingestion_time, l_orderkey AS source_match_id, CAST(l_linenumber AS BIGINT) AS matchday, 'FINISHED' AS status,
           l_shipdate AS utc_date, l_suppkey AS home_team_id, l_partkey AS away_team_id, CAST(l_quantity AS BIGINT) AS home_score, NULL::BIGINT AS away_score FROM s
    UNION ALL SELECT season, l_returnflag, l_shipdate, l_orderkey + 1, NULL, l_linestatus, l_shipdate, l_partkey, l_suppkey, NULL, 2 FROM s""")
def stage_matches(spark, sf):
    stamp = "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    payload = f"""to_json(named_struct('filters', named_struct('x', 1), 'matches', array(
        named_struct('id', l_orderkey, 'matchday', l_linenumber, 'status', 'FINISHED', 'utcDate', {stamp},
          'homeTeam', named_struct('id', l_suppkey), 'awayTeam', named_struct('id', l_partkey),
          'score', named_struct('fullTime', named_struct('home', int(l_quantity), 'away', int(null)))),
        named_struct('id', l_orderkey + 1, 'matchday', int(null), 'status', l_linestatus, 'utcDate', {stamp},
          'homeTeam', named_struct('id', l_partkey), 'awayTeam', named_struct('id', l_suppkey),
          'score', named_struct('fullTime', named_struct('home', int(null), 'away', 2))))))"""
    bronze = _bronze(table(spark, sf, "lineitem"), PRIMARY, "matches", payload, _YEAR_SEASON, "l_returnflag", "l_shipdate")
    return _comparable(staging.primary_matches(bronze))


@query("stage_squads", """SELECT NULL::VARCHAR AS season, c_mktsegment AS league, TIMESTAMP '2024-01-01' AS ingestion_time, CAST(c_nationkey AS BIGINT) AS team_id, c_custkey AS player_id, c_name AS player_name,
    'Defence' AS position, DATE '1990-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS date_of_birth, 'X' AS nationality, c_custkey % 99 AS shirt_number FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT NULL, c_mktsegment, TIMESTAMP '2024-01-01', c_nationkey, c_custkey + 1, NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_acctbal >= 0""")
def stage_squads(spark, sf):
    payload = """to_json(named_struct('id', c_nationkey, 'squad', if(c_acctbal < 0, array(), array(
        named_struct('id', c_custkey, 'name', c_name, 'position', 'Defence', 'dateOfBirth', string(date_add(date'1990-01-01', int(c_custkey % 5000))),
          'nationality', 'X', 'shirtNumber', c_custkey % 99),
        named_struct('id', c_custkey + 1, 'name', string(null), 'position', string(null), 'dateOfBirth', string(null), 'nationality', string(null), 'shirtNumber', bigint(null))))))"""
    bronze = _bronze(table(spark, sf, "customer"), PRIMARY, "players", payload, "string(null)", "c_mktsegment", "timestamp_ntz'2024-01-01'")
    return _comparable(staging.primary_players(bronze))


_STANDINGS_PAYLOAD = """to_json(named_struct('standings', array(
    named_struct('type', 'HOME', 'table', array(named_struct('position', 9, 'team', named_struct('id', bigint(-1), 'name', 'x', 'shortName', 'x', 'tla', 'x'),
      'playedGames', 1, 'won', 1, 'draw', 0, 'lost', 0, 'points', 3, 'goalsFor', 1, 'goalsAgainst', 0, 'goalDifference', 1, 'form', 'W'))),
    named_struct('type', 'TOTAL', 'table', array(
      named_struct('position', p_size, 'team', named_struct('id', p_partkey, 'name', p_name, 'shortName', p_type, 'tla', p_brand),
        'playedGames', p_size + 1, 'won', 1, 'draw', 2, 'lost', 3, 'points', 5, 'goalsFor', p_size, 'goalsAgainst', 4, 'goalDifference', p_size - 4, 'form', 'W,D'),
      named_struct('position', int(null), 'team', named_struct('id', if(p_size > 25, p_partkey + 1, null), 'name', p_type, 'shortName', string(null), 'tla', string(null)),
        'playedGames', 0, 'won', 0, 'draw', 0, 'lost', 0, 'points', 0, 'goalsFor', 0, 'goalsAgainst', 0, 'goalDifference', 0, 'form', string(null)))))))"""


def _standings_docs(spark, sf):
    return _bronze(table(spark, sf, "part"), PRIMARY, "standings", _STANDINGS_PAYLOAD, "p_brand", "p_type", "timestamp_ntz'2024-01-01'")


_SQL_STANDINGS = """SELECT p_brand AS season, p_type AS league, TIMESTAMP '2024-01-01' AS ingestion_time, p_partkey AS team_id, p_name AS team_name, p_type AS team_short_name, p_brand AS team_tla, p_size::BIGINT AS position,
    p_size::BIGINT + 1 AS played_games, 1::BIGINT AS won, 2::BIGINT AS draw, 3::BIGINT AS lost, 5::BIGINT AS points, p_size::BIGINT AS goals_for, 4::BIGINT AS goals_against, p_size::BIGINT - 4 AS goal_difference, 'W,D' AS form FROM part
    UNION ALL SELECT p_brand, p_type, TIMESTAMP '2024-01-01', CASE WHEN p_size > 25 THEN p_partkey + 1 END, p_type, NULL, NULL, NULL, 0, 0, 0, 0, 0, 0, 0, 0, NULL FROM part"""


@query("stage_standings", _SQL_STANDINGS)
def stage_standings(spark, sf):
    return _comparable(staging.primary_standings(_standings_docs(spark, sf)))


_STANDING_ORDER = ", ".join(f"{c} NULLS LAST" for c in silver.STANDING_COLUMNS)


@query("silver_standings", f"""SELECT league, season, team_id, {", ".join(silver.STANDING_COLUMNS)}, ingestion_time FROM ({_SQL_STANDINGS})
    QUALIFY row_number() OVER (PARTITION BY league, season, team_id ORDER BY ingestion_time DESC, {_STANDING_ORDER}) = 1""")
def silver_standings(spark, sf):
    return _comparable(silver.standings(staging.primary_standings(_standings_docs(spark, sf))))


@query("silver_teams", f"SELECT DISTINCT team_id, team_name, team_short_name, team_tla, league FROM ({_SQL_STANDINGS}) WHERE team_id IS NOT NULL")
def silver_teams(spark, sf):
    return _comparable(silver.teams(staging.primary_standings(_standings_docs(spark, sf))))


@query("stage_team_ids", "SELECT p_brand AS season, p_type AS league, TIMESTAMP '2024-01-01' AS ingestion_time, p_partkey AS team_id FROM part UNION ALL SELECT p_brand, p_type, TIMESTAMP '2024-01-01', p_partkey + 1 FROM part WHERE p_size > 25")
def stage_team_ids(spark, sf):
    return _comparable(staging.primary_team_ids(_standings_docs(spark, sf)))


def _team_map(spark, sf) -> DataFrame:
    """Both sources' raw supplier names; three in ten suppliers stay unmapped."""
    s = table(spark, sf, "supplier").filter("s_acctbal > 2000")
    both = F.explode(F.array(F.lit(TERTIARY), F.lit(SECONDARY))).alias("source")
    return s.select(both, F.col("s_name").alias("raw_team_name"), F.col("s_suppkey").alias("team_id"))


@query("stage_tertiary_players", """SELECT p_brand AS season, p_type AS league, TIMESTAMP '2024-01-01' AS ingestion_time, m.s_suppkey AS team_id, p_name AS raw_player_name, p_size::BIGINT AS goals,
    0::BIGINT AS fh, 0::BIGINT AS sh, p_size::BIGINT AS fs, 1::BIGINT AS ls, 2::BIGINT AS h, 3::BIGINT AS a FROM part
    LEFT JOIN supplier s ON s.s_suppkey = p_size LEFT JOIN supplier m ON m.s_name = s.s_name AND m.s_acctbal > 2000""")
def stage_tertiary_players(spark, sf):
    payload = """to_json(array(named_struct('player', p_name, 'goals', string(p_size), 'fh', '-', 'sh', string(null), 'fs', string(p_size), 'ls', '1', 'h', '2', 'a', '3', 'team', s_name)))"""
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("p_size"), "s_name")
    rows = table(spark, sf, "part").join(names, "p_size", "left")
    bronze = _bronze(rows, TERTIARY, "player_stats", payload, "p_brand", "p_type", "timestamp_ntz'2024-01-01'")
    return _comparable(staging.tertiary_player_stats(bronze, _team_map(spark, sf)))


_SQL_TABLE_DOCS = """SELECT l_linestatus AS season, l_returnflag AS league, l_shipdate AS ingestion_time, s.s_name AS raw_team_name, m.s_suppkey AS team_id, CAST(l_linenumber AS BIGINT) AS rank,
    CAST(l_quantity AS BIGINT) AS played, 1::BIGINT AS wins, 2::BIGINT AS draws, 3::BIGINT AS losses, l_partkey AS goals_for, l_orderkey AS goals_against, {more}
    FROM lineitem JOIN supplier s ON s.s_suppkey = l_suppkey LEFT JOIN supplier m ON m.s_name = s.s_name AND m.s_acctbal > 2000"""
_TABLE_CELLS = """'rank', string(l_linenumber), 'team', s_name, 'played', string(int(l_quantity)), 'wins', '1', 'draws', '2', 'losses', '3',
    'goals_for', string(l_partkey), 'goals_against', string(l_orderkey)"""


def _table_docs(spark, sf, source: str, cells: str) -> DataFrame:
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = table(spark, sf, "lineitem").join(names, "l_suppkey")
    return _bronze(rows, source, "standings", f"to_json(array(named_struct({_TABLE_CELLS}, {cells})))", "l_linestatus", "l_returnflag", "l_shipdate")


@query("stage_tertiary_standings", _SQL_TABLE_DOCS.format(more="l_partkey - l_orderkey AS goal_diff, 5::BIGINT AS points"))
def stage_tertiary_standings(spark, sf):
    docs = _table_docs(spark, sf, TERTIARY, "'club_id', string(l_suppkey), 'goal_diff', string(l_partkey - l_orderkey), 'points', '5'")
    return _comparable(staging.tertiary_standings(docs, _team_map(spark, sf)))


@query("stage_secondary_standings", _SQL_TABLE_DOCS.format(more="5::BIGINT AS points, l_extendedprice AS xg, l_discount AS xga, l_tax AS xpts"))
def stage_secondary_standings(spark, sf):
    docs = _table_docs(spark, sf, SECONDARY, "'points', '5', 'xG', string(l_extendedprice), 'xGA', string(l_discount), 'xPTS', string(l_tax)")
    return _comparable(staging.secondary_standings(docs, _team_map(spark, sf)))


@query("stage_secondary_players", """WITH s AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR) AS season, o_orderkey % 3000 AS minutes, o_orderkey % 5000 AS cents FROM orders)
    SELECT season, o_orderstatus AS league, o_orderdate AS ingestion_time, coalesce(ov.c_nationkey, CASE WHEN o_orderstatus <> 'P' THEN m.s_suppkey END)::BIGINT AS team_id,
      'N&#039;' || o_custkey AS raw_player_name, o_custkey AS understat_id, o_orderkey % 39 AS apps, minutes, o_orderkey % 31 AS goals, o_orderkey % 17 AS assists, cents / 100.0 AS xg, 0.5::DOUBLE AS xa,
      CASE WHEN minutes > 0 THEN ((cents * 1800 + minutes) // (2 * minutes)) / 1000.0 END AS xg90, CASE WHEN minutes > 0 THEN ((50 * 1800 + minutes) // (2 * minutes)) / 1000.0 END AS xa90,
      CASE o_orderstatus WHEN 'F' THEN 'Goalkeeper' WHEN 'O' THEN 'Offence' END AS position
    FROM s LEFT JOIN supplier m ON m.s_suppkey = s.o_custkey AND m.s_acctbal > 2000
    LEFT JOIN customer ov ON ov.c_custkey = o_custkey AND season = '1997-1998' AND ov.c_acctbal > 5000
    WHERE NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = o_custkey AND season = '1998-1999' AND x.c_mktsegment = 'BUILDING')""")
def stage_secondary_players(spark, sf):
    payload = """to_json(array(named_struct('id', string(o_custkey), 'player_name', concat('N&#039;', o_custkey), 'team_title', if(o_orderstatus = 'P', concat(s_name, ',B'), concat(' ', s_name, ' ')),
        'games', string(o_orderkey % 39), 'time', string(o_orderkey % 3000), 'goals', string(o_orderkey % 31), 'assists', string(o_orderkey % 17),
        'xG', string(decimal((o_orderkey % 5000)) / 100), 'xA', '0.5', 'position', case o_orderstatus when 'F' then 'GK S' when 'O' then 'F M' else 'S' end)))"""
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("o_custkey"), "s_name")
    rows = table(spark, sf, "orders").join(names, "o_custkey", "left")
    bronze = _bronze(rows, SECONDARY, "player_stats", payload, "concat(year(o_orderdate), '-', year(o_orderdate) + 1)", "o_orderstatus", "o_orderdate")
    c = table(spark, sf, "customer")
    fixed = c.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("understat_id"), F.lit("1997-1998").alias("season"), F.col("c_nationkey").cast("bigint").alias("team_id"))
    dropped = c.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("understat_id"), F.lit("1998-1999").alias("season"))
    return _comparable(staging.secondary_player_stats(bronze, _team_map(spark, sf), fixed, dropped))


# --- document identity and load ------------------------------------------------

_SQL_RECORDS = """
docs AS (SELECT event_id, event_type AS source, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value > 20 AS in_bronze, event_type = 'error' AS broken FROM events)"""


def _event_docs(spark, sf) -> DataFrame:
    """One document per event; key order and blanks vary, errors are cut short."""
    k, u = json_field("props", "$.k", "string"), F.col("user_id").cast("string")
    one = F.concat(F.lit('{"k": '), k, F.lit(', "u": '), u, F.lit("}"))
    other = F.concat(F.lit('{ "u":'), u, F.lit(',"k":'), k, F.lit("}"))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("rel_path"), F.col("event_type").alias("source"), F.lit("matches").alias("entity_type"),
        F.when(F.col("event_type") == "error", F.substring(one, 1, 7)).when(F.col("event_id") % 2 == 0, one).otherwise(other).alias("payload"),
        F.concat(F.when(F.col("user_id") < 20, "PL_x").otherwise("PL_2024"), F.lit("_1.json")).alias("file_name"), "value",
    )


@query("json_hash_dedup", f"WITH {_SQL_RECORDS} SELECT source, user_id, k, min(event_id) AS first_event, count(*) AS copies FROM docs WHERE NOT broken GROUP BY 1, 2, 3")
def json_hash_dedup(spark, sf):
    docs = _event_docs(spark, sf).withColumn("content_hash", canonical_hash("payload")).filter("content_hash is not null")
    doc = F.any_value("payload")
    found = docs.groupBy("source", "content_hash").agg(doc.alias("doc"), F.min("rel_path").alias("first_event"), F.count(F.lit(1)).alias("copies"))
    return found.select(
        "source", json_field("doc", "$.u", "bigint").alias("user_id"), json_field("doc", "$.k", "bigint").alias("k"), "first_event", "copies"
    )


@query("insert_if_absent", f"""WITH {_SQL_RECORDS} SELECT source, user_id, k, min(event_id) AS event_id FROM docs d WHERE NOT broken AND user_id >= 20
    AND NOT EXISTS (SELECT 1 FROM docs b WHERE b.in_bronze AND NOT b.broken AND b.source = d.source AND b.user_id = d.user_id AND b.k = d.k) GROUP BY 1, 2, 3""")
def insert_if_absent(spark, sf):
    docs = _event_docs(spark, sf)
    good, _ = parse_documents(docs)
    loaded = docs.filter("value > 20").withColumn("content_hash", canonical_hash("payload"))
    fresh = new_records(good, loaded.filter("content_hash is not null"))
    return fresh.select(
        "source", json_field("payload", "$.u", "bigint").alias("user_id"), json_field("payload", "$.k", "bigint").alias("k"),
        F.col("rel_path").alias("event_id"),
    )


@query("quarantine", f"WITH {_SQL_RECORDS} SELECT event_id AS rel_path, source, 'matches' AS entity_type, CASE WHEN broken THEN 'invalid json' ELSE 'bad season' END AS reason FROM docs WHERE broken OR user_id < 20")
def quarantine(spark, sf):
    return parse_documents(_event_docs(spark, sf))[1]


@query("ingest_summary", f"""WITH {_SQL_RECORDS}, good AS (SELECT * FROM docs WHERE NOT broken AND user_id >= 20), fresh AS (SELECT DISTINCT source, user_id, k FROM good)
    SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM good) - (SELECT count(*) FROM fresh) AS skipped, (SELECT count(*) FROM docs WHERE broken OR user_id < 20) AS failed""")
def ingest_summary(spark, sf):
    good, bad = parse_documents(_event_docs(spark, sf))
    return outcome_counts(good, bad, new_records(good, None).count())


@query("json_rows", "SELECT to_json({'c_custkey': c_custkey, 'c_name': c_name, 'segment': CASE WHEN c_acctbal > 0 THEN c_mktsegment END})::VARCHAR AS row_json FROM customer")
def json_rows(spark, sf):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")
    return rows_as_json(table(spark, sf, "customer").select("c_custkey", "c_name", segment))


# --- pages ----------------------------------------------------------------------

def _td(*cells: str) -> str:
    return ", ".join(f"'<td>', {c}, '</td>'" for c in cells)


_DECOY = "'<div><table class=\"nav\"><tbody><tr><td>skip</td></tr></tbody></table></div>'"


@query("page_league_rows", """SELECT p_partkey AS page_id, CAST(0 AS BIGINT) AS row_no, CAST(p_size AS VARCHAR) AS rank, p_name AS team, CASE WHEN p_size > 10 THEN CAST(p_partkey AS VARCHAR) END AS club_id, '1' AS played, '2' AS wins, '3' AS draws,
    '4' AS losses, '5' AS goals_for, '6' AS goals_against, '-1' AS goal_diff, '9' AS points FROM part""")
def page_league_rows(spark, sf):
    link = "if(p_size > 10, concat('<a href=\"/club?x=1&amp;club_id=', p_partkey, '#t\"><p> ', p_name, ' </p></a>'), concat('<p>', p_name, '</p>'))"
    row = _td("p_size", link, *[f"'{v}'" for v in (" 1 ", 2, 3, 4, 5, 6, -1, 9)])
    html = f"concat({_DECOY}, '<table class=\"big table\"><thead><tr><td>h</td></tr></thead><tbody><tr>', {row}, '</tr><tr><td>short</td></tr></tbody></table>')"
    parts = pages.dealt(table(spark, sf, "part").select("p_partkey", "p_size", "p_name"), "p_partkey")
    docs = parts.select(F.col("p_partkey").alias("page_id"), F.expr(html).alias("html"))
    return _comparable(pages.league_rows(docs))


@query("page_scorer_rows", """SELECT c_custkey AS page_id, c_mktsegment AS team, CAST(0 AS BIGINT) AS row_no, c_name AS player, CAST(c_nationkey AS VARCHAR) AS goals, '-' AS fh, '2' AS sh, '3' AS fs, '4' AS ls, '5' AS h, '6' AS a FROM customer""")
def page_scorer_rows(spark, sf):
    row = _td("concat('<p>', c_name, '</p>')", "c_nationkey", *[f"'{v}'" for v in ("-", 2, 3, 4, 5, 6)])
    html = f"concat('<table class=\"table\"><tbody><tr>', {row}, '</tr><tr>', {row.replace('<p>', '<b>')}, '</tr></tbody></table>')"
    players = pages.dealt(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", "c_nationkey"), "c_custkey")
    docs = players.select(F.col("c_custkey").alias("page_id"), F.col("c_mktsegment").alias("team"), F.expr(html).alias("html"))
    return _comparable(pages.scorer_rows(docs))


@query("page_expected_goals", """SELECT o_orderkey AS page_id, CAST(0 AS BIGINT) AS row_no, '1' AS rank, o_orderpriority AS team, '2' AS played, '3' AS wins, '4' AS draws, '5' AS losses, '6' AS goals_for, '7' AS goals_against, '8' AS points,
    o_custkey || '.5' AS "xG", '-3.5' AS "xGA", CASE WHEN o_orderstatus = 'F' THEN '7.25' ELSE '' END AS "xPTS" FROM orders""")
def page_expected_goals(spark, sf):
    xg = "concat(o_custkey, '.5<sup>+1.2</sup>')"
    xpts = "if(o_orderstatus = 'F', '7.25<sup>-0.4</sup>', '7.25')"
    row = _td("'1'", "concat('<a href=\"t\">', o_orderpriority, '</a>')", *[f"'{v}'" for v in (2, 3, 4, 5, 6, 7, 8)], xg, "'-3.5'", xpts)
    html = f"concat('<table><tbody><tr>', {row}, '</tr></tbody></table>', {_DECOY})"
    orders = pages.dealt(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    docs = orders.select(F.col("o_orderkey").alias("page_id"), F.expr(html).alias("html"))
    return _comparable(pages.expected_goal_rows(docs))


@query("page_tables", "SELECT page_id, CAST(r AS BIGINT) AS row_no FROM (SELECT page_id, unnest(range(1 + page_id % 3)) AS r FROM pages)")
def page_tables(spark, sf):
    """The crawled pages, which carry no tables of their own, behind a table of one to three rows."""
    rows = F.concat(F.lit("<tr><td>"), F.col("page_id").cast("string"), F.lit("</td><td>x</td></tr>"))
    front = F.concat(F.lit("<html><body><table><tbody>"), F.repeat(rows, (F.col("page_id") % 3 + 1).cast("int")), F.lit("</tbody></table>"))
    docs = table(spark, sf, "pages").select("page_id", F.concat(front, F.coalesce("html", F.lit(""))).alias("html"))
    return _comparable(pages.table_cells(docs).select("page_id", "row_no"))


@query("page_player_array", "SELECT s_suppkey AS page_id, CASE WHEN s_acctbal > 0 THEN '[{\"id\":' || s_suppkey || ',\"name\":\"' || s_name || '\"}]' ELSE '[]' END AS players FROM supplier")
def page_player_array(spark, sf):
    body = """if(s_acctbal > 0, to_json(named_struct('players', array(named_struct('name', s_name, 'id', s_suppkey)), 'dates', array(1))), '{"dates": []}')"""
    return pages.player_array(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("page_id"), F.expr(body).alias("body")))


@query("adhoc_sql", f"""WITH {SQL_MATCHES},{SQL_TEAMS}, open_matches AS (SELECT home_team_id, count(*) AS n FROM matches WHERE status = 'SCHEDULED' GROUP BY 1)
    SELECT team_id, team_name, n FROM teams JOIN open_matches ON home_team_id = team_id ORDER BY n DESC, team_id LIMIT 100""")
def adhoc_sql(spark, sf):
    clubs = teams(spark, sf)
    marts = {"team_profile": gold.team_profile(clubs), "match_results": gold.match_results(matches(spark, sf), clubs)}
    return adhoc.run_readonly(spark, marts, """
        WITH open_matches AS (SELECT home_team_id, count(*) AS n FROM gold.match_results WHERE status = 'SCHEDULED' GROUP BY 1)
        SELECT t.team_id, t.team_name, o.n FROM gold.team_profile t JOIN open_matches o ON o.home_team_id = t.team_id
        ORDER BY o.n DESC, t.team_id LIMIT 5000;""")
