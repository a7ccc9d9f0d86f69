"""Match marts and reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.dates import season_of_year
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key
from touchline.operators.scans import falling, rank_within
from touchline.plans import gold, reads, silver
from touchline.registry.base import (
    SQL_BY_MATCHDAY, SQL_MATCHES, SQL_SIDES, SQL_SNAPSHOTS, SQL_TEAM_SEASONS, SQL_TEAMS, match_snapshots, match_table, matches, query,
    table, team_seasons, teams,
)

AS_OF = "1998-07-01"
RECORD = ["played_games", "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_difference"]


def _results(spark, sf):
    return gold.match_results(matches(spark, sf), teams(spark, sf))


SQL_RESULTS = SQL_MATCHES + "," + SQL_TEAMS + """,
results AS (
  SELECT m.*, h.team_name AS home_team_name, a.team_name AS away_team_name
  FROM matches m LEFT JOIN teams h ON h.team_id = m.home_team_id LEFT JOIN teams a ON a.team_id = m.away_team_id
)"""


@query(
    "latest_match_snapshot",
    f"""WITH {SQL_SNAPSHOTS},
    picked AS (
      SELECT *, row_number() OVER (PARTITION BY source_match_id ORDER BY utc_date DESC, status, home_team_id,
                                   away_team_id, home_score NULLS LAST, away_score) AS rn
      FROM match_snapshots)
    SELECT 'football_data_org' AS source, source_match_id, league, season, matchday, status, utc_date, home_team_id,
           away_team_id, home_score, away_score
    FROM picked WHERE rn = 1""",
)
def latest_match_snapshot(spark, sf):
    # several snapshots can be equal in every tie-break but matchday, which the match id implies
    staged = match_snapshots(spark, sf).drop("l_extendedprice").withColumn("ingestion_time", F.col("utc_date"))
    return silver.matches(staged)


@query("match_results", f"WITH {SQL_RESULTS} SELECT * FROM results")
def match_results(spark, sf):
    return _results(spark, sf)


@query(
    "season_in_progress",
    f"WITH {SQL_MATCHES} SELECT DISTINCT league, season FROM matches WHERE status NOT IN ('FINISHED', 'AWARDED')",
)
def season_in_progress(spark, sf):
    return gold.season_in_progress(matches(spark, sf))


@query(
    "team_form",
    f"""WITH {SQL_MATCHES},{SQL_SIDES},{SQL_TEAMS},
    ranked AS (
      SELECT *, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS res,
             row_number() OVER (PARTITION BY league, season, team_id
                                ORDER BY utc_date DESC, source_match_id DESC) AS rn
      FROM sides WHERE status = 'FINISHED')
    SELECT league, season, r.team_id, team_name, count(*) AS matches_played,
           count(*) FILTER (res = 'W') AS wins, count(*) FILTER (res = 'D') AS draws,
           count(*) FILTER (res = 'L') AS losses,
           CAST(sum(CASE res WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) AS BIGINT) AS points,
           CAST(sum(gf) AS BIGINT) AS goals_for, CAST(sum(ga) AS BIGINT) AS goals_against,
           string_agg(res, '' ORDER BY rn) AS form
    FROM ranked r JOIN teams t ON t.team_id = r.team_id WHERE rn <= 5
    GROUP BY ALL""",
)
def team_form(spark, sf):
    return gold.team_form(matches(spark, sf), teams(spark, sf))


@query("standings_by_matchday", f"WITH {SQL_BY_MATCHDAY} SELECT * FROM by_matchday")
def standings_by_matchday(spark, sf):
    return gold.standings_by_matchday(match_table(spark, sf))


def _sql_as_of(moment: str, dates: str = "") -> str:
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in RECORD)
    return f"""WITH {SQL_BY_MATCHDAY},{SQL_TEAMS},{SQL_TEAM_SEASONS}{dates},
    picked AS (
      SELECT * FROM (
        SELECT b.*, {moment} AS as_of, row_number() OVER (PARTITION BY {moment}, b.league, b.season, b.team_id
               ORDER BY b.utc_date DESC, b.source_match_id DESC) AS rn
        FROM by_matchday b {'JOIN dates d ON d.league = b.league AND d.season = b.season' if dates else ''}
        WHERE b.utc_date <= {moment}) WHERE rn = 1),
    filled AS (
      SELECT {'d.as_of, ' if dates else ''}ts.league, ts.season, ts.team_id, ts.team_name, ts.team_short_name, ts.team_tla, {zero}
      FROM team_seasons ts {'JOIN dates d ON d.league = ts.league AND d.season = ts.season' if dates else ''}
      LEFT JOIN picked p ON p.league = ts.league AND p.season = ts.season AND p.team_id = ts.team_id
           {'AND p.as_of = d.as_of' if dates else ''})
    SELECT *, row_number() OVER (PARTITION BY {'as_of, ' if dates else ''}league, season
             ORDER BY points DESC, goal_difference DESC, goals_for DESC, team_id) AS position
    FROM filled"""


@query("standings_as_of", _sql_as_of(f"DATE '{AS_OF}'"))
def standings_as_of(spark, sf):
    played, moment = match_table(spark, sf), F.lit(AS_OF).cast("date")
    return reads.standings_from_results(team_seasons(spark, sf, played), played, moment)


_SQL_DATES = """,
dates AS (SELECT DISTINCT league, season, date_trunc('quarter', utc_date)::TIMESTAMP AS as_of FROM matches)"""


@query("standings_at_dates", _sql_as_of("d.as_of", _SQL_DATES))
def standings_at_dates(spark, sf):
    played = match_table(spark, sf)
    quarter = F.date_trunc("quarter", "utc_date").cast("timestamp_ntz")
    dates = played.select("league", "season", quarter.alias("as_of")).distinct()
    by_matchday = cut_lineage(gold.standings_by_matchday(played))
    return reads.standings_at_dates(team_seasons(spark, sf, played), by_matchday, dates)


@query(
    "recent_matches",
    f"WITH {SQL_RESULTS} SELECT * FROM results WHERE status = 'FINISHED' ORDER BY utc_date DESC, source_match_id LIMIT 50",
)
def recent_matches(spark, sf):
    return reads.recent_matches(_results(spark, sf), limit=50)


@query(
    "recent_matches_of_league",
    f"WITH {SQL_RESULTS} SELECT * FROM results WHERE status = 'FINISHED' AND league = 'A' ORDER BY utc_date DESC, source_match_id LIMIT 10",
)
def recent_matches_of_league(spark, sf):
    return reads.recent_matches(_results(spark, sf), league="A")


@query(
    "team_matches",
    f"WITH {SQL_RESULTS} SELECT * FROM results WHERE (home_team_id = 8 OR away_team_id = 8) AND season = '1997-1998'",
)
def team_matches(spark, sf):
    return reads.team_matches(_results(spark, sf), 8, "1997-1998")


@query("match_by_id", f"WITH {SQL_RESULTS} SELECT * FROM results WHERE source_match_id = (SELECT min(source_match_id) FROM results)")
def match_by_id(spark, sf):
    first = match_snapshots(spark, sf).agg(F.min("source_match_id")).first()[0]
    return reads.by_id(_results(spark, sf), "source_match_id", first)


# Final tables: the last cumulative row of each team-season, placed within its league and season.
_FINAL = """
final AS (
  SELECT league, season, team_id, played_games, won, draw, lost, points, goals_for, goals_against,
         goal_difference,
         row_number() OVER (PARTITION BY league, season ORDER BY points DESC, goal_difference DESC NULLS LAST,
                            goals_for DESC NULLS LAST, team_id) AS position
  FROM (SELECT *, row_number() OVER (PARTITION BY league, season, team_id
                                     ORDER BY utc_date DESC, source_match_id DESC) AS rn FROM by_matchday)
  WHERE rn = 1)"""
_XG = """
xg_rows AS (
  SELECT l_returnflag AS league, CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) + 1 AS VARCHAR) AS season,
         l_suppkey * 2 AS team_id, l_shipdate AS ingestion_time, l_extendedprice AS xg, l_quantity AS xga, l_tax AS xpts
  FROM lineitem),
xg_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY league, season, team_id
                        ORDER BY ingestion_time DESC, xg, xga, xpts) AS rn FROM xg_rows) WHERE rn = 1)"""
SQL_STANDINGS = SQL_BY_MATCHDAY + "," + SQL_TEAMS + "," + _FINAL + "," + _XG + """,
standings AS (
  SELECT f.*, t.team_name, substr(t.team_name, 1, 8) AS team_short_name, t.team_tla, CAST(NULL AS VARCHAR) AS form,
         x.xg, x.xga, x.xpts
  FROM final f JOIN teams t USING (team_id)
  LEFT JOIN xg_latest x ON x.league = f.league AND x.season = f.season AND x.team_id = f.team_id)"""


def _standings(spark, sf):
    newest = latest_per_key(
        gold.standings_by_matchday(match_table(spark, sf)), ["league", "season", "team_id"],
        [F.col("utc_date").desc(), F.col("source_match_id").desc()],
    ).drop("source_match_id", "utc_date")
    newest = cut_lineage(newest)
    order = [*falling("points", "goal_difference", "goals_for"), F.col("team_id")]
    placed = rank_within(newest, ["league", "season"], order)
    placed = placed.withColumn("form", F.lit(None).cast("string"))
    xg = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("league"), season_of_year(F.year("l_shipdate")).alias("season"),
        (F.col("l_suppkey") * 2).alias("team_id"), F.col("l_shipdate").alias("ingestion_time"),
        F.col("l_extendedprice").alias("xg"), F.col("l_quantity").alias("xga"), F.col("l_tax").alias("xpts"),
    )
    return gold.league_standings(placed, teams(spark, sf), xg)


@query("league_standings", f"WITH {SQL_STANDINGS} SELECT * FROM standings")
def league_standings(spark, sf):
    return _standings(spark, sf)


@query("league_table_latest", f"WITH {SQL_STANDINGS} SELECT * FROM standings WHERE league = 'N' AND season = (SELECT max(season) FROM standings WHERE league = 'N')")
def league_table_latest(spark, sf):
    return reads.league_table(_standings(spark, sf), "N")


@query("league_list", f"WITH {SQL_MATCHES},{SQL_SIDES} SELECT league, array_to_string(list_sort(list(DISTINCT season), 'DESC'), ',') AS seasons FROM sides GROUP BY league")
def league_list(spark, sf):
    m = matches(spark, sf)
    return reads.list_leagues(m).withColumn("seasons", F.array_join("seasons", ","))


@query("league_teams", f"WITH {SQL_MATCHES},{SQL_SIDES},{SQL_TEAMS},{SQL_TEAM_SEASONS} SELECT DISTINCT team_id, team_name, team_short_name, team_tla FROM team_seasons WHERE league = 'R' AND season = (SELECT max(season) FROM team_seasons WHERE league = 'R')")
def league_teams(spark, sf):
    return reads.league_teams(team_seasons(spark, sf), "R")


@query("resolve_season", f"""WITH {SQL_MATCHES} SELECT w.league, max(season) AS season FROM (SELECT unnest(['A', 'no such league']) AS league) w
    JOIN matches m ON m.league = w.league GROUP BY 1""")
def resolve_season(spark, sf):
    """The latest season of a league, and of one that does not exist: that one has no row."""
    played = matches(spark, sf)
    found = [reads.resolve_season(played, league).select(F.lit(league).alias("league"), "season") for league in ("A", "no such league")]
    return found[0].unionByName(found[1])


@query("league_matches", f"WITH {SQL_RESULTS} SELECT * FROM results WHERE league = 'A' AND season = (SELECT max(season) FROM results WHERE league = 'A')")
def league_matches(spark, sf):
    r = _results(spark, sf)
    return reads.league_matches(r, r, "A")


_FORM = f"""{SQL_MATCHES},{SQL_SIDES},{SQL_TEAMS},
ranked AS (
  SELECT *, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS res,
         row_number() OVER (PARTITION BY league, season, team_id ORDER BY utc_date DESC, source_match_id DESC) AS rn
  FROM sides WHERE status = 'FINISHED'),
form AS (
  SELECT league, season, r.team_id, team_name, string_agg(res, '' ORDER BY rn) AS form
  FROM ranked r JOIN teams t ON t.team_id = r.team_id WHERE rn <= 5 GROUP BY ALL),
last AS (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY season DESC, league) AS rn FROM form)"""


@query("latest_team_form", f"WITH {_FORM} SELECT league, season, team_id, team_name, form, array_to_string(regexp_extract_all(form, '.'), '|') AS letters FROM last WHERE rn = 1")
def latest_team_form(spark, sf):
    form = reads.latest_team_form(gold.team_form(matches(spark, sf), teams(spark, sf)))
    badges = reads.form_badges(form).withColumn("letters", F.array_join("letters", "|"))
    return badges.select("league", "season", "team_id", "team_name", "form", "letters")


@query("team_profile", f"WITH {SQL_TEAMS} SELECT team_id, team_name, substr(team_name, 1, 8) AS team_short_name, team_tla, 'all' AS league FROM teams")
def team_profile(spark, sf):
    return gold.team_profile(teams(spark, sf))
