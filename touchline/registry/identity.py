"""Player identity, season attribution and player marts (V4-V12, G3-G5, R11-R13, R15, DQ7-DQ10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators.joins import with_one_row
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key
from touchline.plans import gold, quality, reads, silver
from touchline.registry.base import (
    SQL_MATCHES, SQL_STAGED_PLAYERS, SQL_TEAMS, display_names, extra_info, matches, name_map, query, staged_primary,
    staged_secondary, staged_tertiary, teams,
)

TODAY = "2025-06-30"


def _sql_norm(c: str) -> str:
    return f"regexp_replace(lower(strip_accents(replace({c}, '&#039;', ''''))), '[^a-z0-9]+', ' ', 'g')"


def _sql_half_up(cents: str) -> str:
    """Hundredths per 90 minutes, rounded half up to three digits in integer arithmetic."""
    return f"CASE WHEN minutes > 0 THEN (({cents} * 1800 + minutes) // (2 * minutes)) / 1000.0 END"


_SQL_PLAYERS = SQL_STAGED_PLAYERS + f""",
newest AS (SELECT unnest(arg_max(p, p.ingestion_time)) FROM p_players p GROUP BY p.player_id),
p_unique AS (
  SELECT norm_name, ids[1] AS player_id
  FROM (SELECT {_sql_norm('player_name')} AS norm_name, list(player_id) AS ids FROM newest GROUP BY 1) WHERE len(ids) = 1),
foreign_people AS (
  SELECT q.understat_id, q.team_id, q.league, q.position, replace(q.raw_player_name, '&#039;', '''') AS label
  FROM (SELECT unnest(arg_max(s, s.ingestion_time)) FROM s_stats s GROUP BY s.understat_id) q),
recognised AS (
  SELECT f.understat_id FROM foreign_people f JOIN p_unique u ON u.norm_name = {_sql_norm('f.label')}
  UNION
  SELECT f.understat_id FROM foreign_people f SEMI JOIN (FROM name_map WHERE source = 'understat' AND player_id IS NOT NULL) nm
  ON nm.raw_player_name = f.label AND nm.team_id = f.team_id),
everyone AS (
  SELECT player_id, player_name, position, date_of_birth, nationality, shirt_number, team_id, league, true AS own FROM newest
  UNION ALL BY NAME
  SELECT understat_id + 100000000 AS player_id, label AS player_name, position, league, false AS own
  FROM foreign_people ANTI JOIN recognised USING (understat_id)),
players AS (
  SELECT e.player_id, coalesce(CASE WHEN own THEN display_name END, player_name) AS player_name, e.position,
         coalesce(date_of_birth, x_dob) AS date_of_birth, coalesce(nationality, x_nat) AS nationality,
         coalesce(shirt_number, x_shirt) AS shirt_number, e.team_id, e.league
  FROM everyone e LEFT JOIN display d ON d.player_id = e.player_id LEFT JOIN extra x ON x.player_id = e.player_id)"""

# Both sources as one long table of facts; every rule that names a player for a fact is a vote, and the first rule wins.
_SQL_PTS = _SQL_PLAYERS + f""",
facts AS MATERIALIZED (
  SELECT row_number() OVER () AS fact, * FROM (
    SELECT 1 AS prio, 'understat' AS via, * FROM s_stats UNION ALL BY NAME SELECT 2 AS prio, 'statbunker' AS via, * FROM t_stats)),
votes AS (
  SELECT fact, nm.player_id, 1 AS rule FROM facts f, name_map nm
  WHERE nm.source = f.via AND nm.raw_player_name = f.raw_player_name AND nm.team_id = f.team_id
  UNION ALL
  SELECT fact, player_id, 2 FROM facts JOIN players ON players.player_id = facts.understat_id + 100000000
  UNION ALL
  SELECT fact, ids[1], 3 FROM facts
  JOIN (SELECT {_sql_norm('player_name')} AS n, list(player_id) AS ids FROM players GROUP BY 1 HAVING count(*) = 1) ON n = {_sql_norm('raw_player_name')}),
owned AS (
  SELECT facts.*, player_id FROM facts JOIN (SELECT fact, arg_min(player_id, rule) AS player_id FROM votes GROUP BY fact) USING (fact)),
current_facts AS (SELECT unnest(arg_max(o, o.ingestion_time)) FROM owned o GROUP BY o.via, o.player_id, o.season),
s_latest AS (
  SELECT *, {_sql_half_up('xg_cents')} AS xg90, {_sql_half_up('xa_cents')} AS xa90 FROM current_facts WHERE via = 'understat'),
t_latest AS (FROM current_facts WHERE via = 'statbunker'),
seasons AS (SELECT DISTINCT season FROM current_facts),
fallback AS (
  SELECT player_id, max(seasons.season) AS season, any_value(league) AS league, team_id
  FROM players, seasons WHERE team_id IS NOT NULL GROUP BY player_id, team_id),
attributed AS (
  SELECT player_id, season, arg_min(league, prio) FILTER (team_id IS NOT NULL) AS league,
         arg_min(team_id, prio) AS team_id, arg_min(via, prio) FILTER (team_id IS NOT NULL) AS resolved_via,
         count(DISTINCT via) FILTER (via <> 'fdo_fallback') = 2
           AND any_value(team_id) FILTER (prio = 1) IS DISTINCT FROM any_value(team_id) FILTER (prio = 2) AS source_disagreement,
         any_value(apps) FILTER (prio = 1) AS apps, any_value(minutes) FILTER (prio = 1) AS minutes,
         any_value(goals) FILTER (prio = 1) AS understat_goals, any_value(assists) FILTER (prio = 1) AS assists,
         any_value(xg_cents) FILTER (prio = 1) AS xg_cents, any_value(xa_cents) FILTER (prio = 1) AS xa_cents,
         any_value(goals) FILTER (prio = 2) AS statbunker_goals
  FROM (FROM current_facts UNION ALL BY NAME SELECT *, 3 AS prio, 'fdo_fallback' AS via FROM fallback)
  GROUP BY player_id, season HAVING count(team_id) > 0),
pts AS (
  SELECT a.* EXCLUDE (xg_cents, xa_cents), xg_cents / 100.0 AS xg, xa_cents / 100.0 AS xa,
         {_sql_half_up('xg_cents')} AS xg90, {_sql_half_up('xa_cents')} AS xa90, p.team_id AS parent_team_id
  FROM attributed a LEFT JOIN players p ON p.player_id = a.player_id),
resolved AS (SELECT player_id, season, league, team_id, resolved_via FROM pts)"""

_SQL_MARTS = _SQL_PTS + "," + SQL_MATCHES + "," + SQL_TEAMS + f""",
open_seasons AS (SELECT league, season FROM matches GROUP BY ALL HAVING bool_or(status NOT IN ('FINISHED', 'AWARDED'))),
placed AS (
  SELECT pts.*, t.team_name, home.team_name AS parent_team_name,
         coalesce(parent_team_id <> pts.team_id OR (pts.team_id IS NULL AND parent_team_id IS NOT NULL), false)
           AND EXISTS (FROM open_seasons o WHERE o.league = pts.league AND o.season = pts.season) AS is_on_loan
  FROM pts LEFT JOIN teams t ON t.team_id = pts.team_id LEFT JOIN teams home ON home.team_id = parent_team_id),
performance AS (
  SELECT player_id, player_name, season, placed.team_id, team_name, placed.league, resolved_via, parent_team_id, parent_team_name, is_on_loan,
         coalesce(statbunker_goals, understat_goals) AS goals, assists, apps, minutes, xg, xa, xg90, xa90
  FROM placed JOIN players USING (player_id)),
profile AS (
  SELECT p.player_id, p.player_name, p.position, p.nationality, p.date_of_birth,
         CAST(date_part('year', age(DATE '{TODAY}', p.date_of_birth)) AS BIGINT) AS age, p.shirt_number,
         l.now.team_id AS team_id, l.now.team_name AS team_name, l.now.parent_team_id AS parent_team_id,
         l.now.parent_team_name AS parent_team_name, coalesce(l.now.is_on_loan, false) AS is_on_loan, coalesce(l.now.league, p.league) AS league
  FROM players p LEFT JOIN (SELECT player_id, arg_max(placed, season) AS now FROM placed GROUP BY player_id) l USING (player_id))"""


def _players(spark, sf):
    return silver.players(
        staged_primary(spark, sf), staged_secondary(spark, sf), name_map(spark, sf), extra_info(spark, sf),
        display_names(spark, sf),
    )


def _sources(spark, sf):
    """Players and both statistics sources, as player_team_season takes them."""
    people = cut_lineage(_players(spark, sf))
    return people, staged_secondary(spark, sf), staged_tertiary(spark, sf), name_map(spark, sf)


def _plain(df):
    """Decimals as doubles, so both sides compare one type."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


@query("identity_union", f"WITH {_SQL_PLAYERS} SELECT * FROM players")
def identity_union(spark, sf):
    return _players(spark, sf).drop("ingestion_time")


@query("unique_name_index", f"WITH {_SQL_PLAYERS} SELECT * FROM p_unique")
def unique_name_index(spark, sf):
    newest = latest_per_key(staged_primary(spark, sf), ["player_id"], [F.col("ingestion_time").desc()])
    return silver.unique_name_index(newest, silver.normalize_name("player_name"), "player_id")


@query("match_secondary", f"WITH {_SQL_PTS} SELECT player_id, season, league, team_id, understat_id, apps, xg90 FROM s_latest")
def match_secondary(spark, sf):
    people, sec, _, names = _sources(spark, sf)
    hit = silver.match_secondary(sec, people, names)
    return _plain(hit.select("player_id", "season", "league", "team_id", "understat_id", "apps", "xg90"))


@query("match_tertiary", f"WITH {_SQL_PTS} SELECT player_id, season, league, team_id, goals FROM t_latest")
def match_tertiary(spark, sf):
    people, _, ter, names = _sources(spark, sf)
    return silver.match_tertiary(ter, people, names).select("player_id", "season", "league", "team_id", "goals")


@query("season_universe", f"WITH {_SQL_PTS} SELECT season, season = (SELECT max(season) FROM seasons) AS is_current FROM seasons")
def season_universe(spark, sf):
    people, sec, ter, names = _sources(spark, sf)
    seasons = silver.season_universe(
        silver.match_secondary(sec, people, names), silver.match_tertiary(ter, people, names)
    )
    last = silver.current_season(seasons).withColumnRenamed("season", "last")
    return with_one_row(seasons, last).select("season", (F.col("season") == F.col("last")).alias("is_current"))


@query("roster_fallback", f"WITH {_SQL_PTS} SELECT * FROM fallback")
def roster_fallback(spark, sf):
    people, sec, ter, names = _sources(spark, sf)
    seasons = silver.season_universe(
        silver.match_secondary(sec, people, names), silver.match_tertiary(ter, people, names)
    )
    return silver.roster_fallback(people, silver.current_season(seasons))


@query("resolve_team_season", f"WITH {_SQL_PTS} SELECT * FROM pts")
def resolve_team_season(spark, sf):
    return _plain(silver.player_team_season(*_sources(spark, sf)))


@query("resolve_by_priority", f"WITH {_SQL_PTS} SELECT player_id, season, league, team_id, resolved_via FROM resolved")
def resolve_by_priority(spark, sf):
    people, sec, ter, names = _sources(spark, sf)
    a, b = silver.match_secondary(sec, people, names), silver.match_tertiary(ter, people, names)
    fallback = silver.roster_fallback(people, silver.current_season(silver.season_universe(a, b)))
    return silver.resolve_by_priority(a, b, fallback)


@query("source_disagreement", f"WITH {_SQL_PTS} SELECT s.player_id, s.season, s.team_id IS DISTINCT FROM t.team_id AS source_disagreement FROM s_latest s JOIN t_latest t ON t.player_id = s.player_id AND t.season = s.season")
def source_disagreement(spark, sf):
    people, sec, ter, names = _sources(spark, sf)
    return silver.source_disagreement(
        silver.match_secondary(sec, people, names), silver.match_tertiary(ter, people, names)
    )


def _marts(spark, sf):
    """(player_performance, player_profile) over one materialised attribution table."""
    people, sec, ter, names = _sources(spark, sf)
    pts = cut_lineage(silver.player_team_season(people, sec, ter, names))
    clubs, played = teams(spark, sf), matches(spark, sf)
    performance = gold.player_performance(pts, people, clubs, played)
    return performance, gold.player_profile(people, pts, clubs, played, F.lit(TODAY).cast("date"))


def _performance(spark, sf):
    return _marts(spark, sf)[0]


@query("player_performance", f"WITH {_SQL_MARTS} SELECT * FROM performance")
def player_performance(spark, sf):
    return _plain(_performance(spark, sf))


@query("player_profile", f"WITH {_SQL_MARTS} SELECT * FROM profile")
def player_profile(spark, sf):
    return _marts(spark, sf)[1].withColumn("age", F.col("age").cast("bigint"))


@query("loan_flag", f"WITH {_SQL_MARTS} SELECT player_id, season, team_id, parent_team_id FROM performance WHERE is_on_loan")
def loan_flag(spark, sf):
    return _performance(spark, sf).filter("is_on_loan").select("player_id", "season", "team_id", "parent_team_id")


@query("top_scorers", f"WITH {_SQL_MARTS} SELECT * FROM performance WHERE goals > 0 AND season = (SELECT max(season) FROM performance) ORDER BY goals DESC, player_name, player_id LIMIT 10")
def top_scorers(spark, sf):
    return _plain(reads.top_players(_performance(spark, sf), "goals"))


@query("top_assists", f"WITH {_SQL_MARTS} SELECT * FROM performance WHERE assists > 0 AND season = '1998-1999' AND league = 'N' ORDER BY assists DESC, player_name, player_id LIMIT 50")
def top_assists(spark, sf):
    return _plain(reads.top_players(_performance(spark, sf), "assists", league="N", season="1998-1999", limit=50))


_SQL_GROUP = "CASE WHEN p.position IN ('Goalkeeper', 'Defence', 'Midfield', 'Offence') THEN p.position ELSE 'No Position Data' END"
_SQL_ORDER = "CASE p.position WHEN 'Goalkeeper' THEN 1 WHEN 'Defence' THEN 2 WHEN 'Midfield' THEN 3 WHEN 'Offence' THEN 4 ELSE 5 END"


@query("team_squad", f"""WITH {_SQL_MARTS}
    SELECT p.player_id, p.player_name, p.position, p.nationality, p.date_of_birth, p.age, p.shirt_number, f.team_id,
           f.team_name, f.league, f.parent_team_id, f.parent_team_name, f.is_on_loan, {_SQL_GROUP} AS position_group,
           CAST({_SQL_ORDER} AS BIGINT) AS group_order
    FROM performance f JOIN profile p ON p.player_id = f.player_id
    WHERE f.team_id = 8 AND f.season = (SELECT max(season) FROM performance) AND f.resolved_via <> 'fdo_fallback'""")
def team_squad(spark, sf):
    squad = reads.team_squad(*_marts(spark, sf), 8)
    grouped = reads.squad_groups(squad)
    return grouped.withColumns({c: F.col(c).cast("bigint") for c in ("age", "group_order")})


@query("squad_by_group", f"""WITH {_SQL_MARTS},
    squad AS (SELECT f.team_id, f.season, p.player_id, p.player_name, p.shirt_number, {_SQL_GROUP} AS position_group, CAST({_SQL_ORDER} AS BIGINT) AS group_order
              FROM performance f JOIN profile p ON p.player_id = f.player_id)
    SELECT team_id, season, group_order, position_group, count(*) AS n_players, string_agg(player_id, ',' ORDER BY shirt_number NULLS LAST, player_name, player_id) AS player_ids
    FROM squad GROUP BY ALL""")
def squad_by_group(spark, sf):
    """Every squad of every season by position group."""
    performance, profile = _marts(spark, sf)
    people = profile.select("player_id", "player_name", "position", "shirt_number")
    squads = reads.squad_by_group(performance.select("player_id", "team_id", "season").join(people, "player_id"), ["team_id", "season"])
    ids = F.array_join(F.transform("players", lambda p: p["player_id"].cast("string")), ",")
    return squads.select("team_id", "season", F.col("group_order").cast("bigint").alias("group_order"), "position_group",
                         F.size("players").cast("bigint").alias("n_players"), ids.alias("player_ids"))


@query("player_season", f"WITH {_SQL_MARTS} SELECT * FROM performance WHERE player_id = 10 AND season = '1997-1998'")
def player_season(spark, sf):
    return _plain(reads.player_season(_performance(spark, sf), 10, "1997-1998"))


@query("dq_unmapped_players", f"""WITH {_SQL_PTS}
    SELECT DISTINCT via AS source, raw_player_name FROM facts
    WHERE fact NOT IN (SELECT fact FROM votes WHERE player_id IS NOT NULL)""")
def dq_unmapped_players(spark, sf):
    people, sec, ter, names = _sources(spark, sf)
    return quality.unmapped_players(sec, ter, people, names)


@query("dq_name_collisions", f"""WITH {SQL_STAGED_PLAYERS},
    counts AS (SELECT {_sql_norm('player_name')} AS norm_name, count(DISTINCT player_id) AS fdo_player_count FROM p_players GROUP BY 1),
    names AS (SELECT DISTINCT raw_player_name FROM s_stats)
    SELECT n.raw_player_name, c.fdo_player_count FROM names n JOIN counts c ON c.norm_name = {_sql_norm('n.raw_player_name')}
    WHERE c.fdo_player_count > 1
      AND NOT EXISTS (SELECT 1 FROM name_map m WHERE m.source = 'understat' AND m.raw_player_name = n.raw_player_name)""")
def dq_name_collisions(spark, sf):
    return quality.name_collisions(staged_primary(spark, sf), staged_secondary(spark, sf), name_map(spark, sf))


@query("dq_source_agreement", f"WITH {_SQL_PTS} SELECT player_id, season FROM pts WHERE source_disagreement")
def dq_source_agreement(spark, sf):
    return quality.disagreements(silver.player_team_season(*_sources(spark, sf)))


@query("dq_loan_consistency", f"""WITH {_SQL_MARTS}
    SELECT player_id, season, team_id, parent_team_id, true AS is_on_loan FROM performance
    WHERE (is_on_loan OR player_id % 3 = 0) AND (parent_team_id IS NULL OR team_id = parent_team_id)
    UNION ALL SELECT player_id, NULL, team_id, parent_team_id, true FROM profile
    WHERE (is_on_loan OR player_id % 5 = 0) AND (parent_team_id IS NULL OR team_id = parent_team_id)""")
def dq_loan_consistency(spark, sf):
    """Both marts with loan flags set for some players whatever their teams."""
    performance, profile = _marts(spark, sf)
    flagged = lambda df, n: df.withColumn("is_on_loan", F.col("is_on_loan") | (F.col("player_id") % n == 0))
    return quality.inconsistent_loans(flagged(performance, 3), flagged(profile, 5))
