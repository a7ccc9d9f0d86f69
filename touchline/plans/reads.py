"""Parameterised reads over the marts (R1-R13, R15, R16). An empty result means not found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import (
    DEFAULT_TOP, FALLBACK, FINISHED, FORM_LETTERS, MAX_TOP, NO_POSITION_GROUP, POSITION_ORDER,
)
from touchline.functions.text import form_letters
from touchline.operators.joins import optional_filters, with_one_row
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key, top_n
from touchline.operators.scans import as_of_join, falling, rank_within
from touchline.plans.gold import records_until

TEAM_COLUMNS = ["team_id", "team_name", "team_short_name", "team_tla"]
RECORD = ["played_games", "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_difference"]


def _table_order() -> list[Column]:
    """League table order; teams level on all three figures are put in id order."""
    return [*falling("points", "goal_difference", "goals_for"), F.col("team_id")]


def list_leagues(standings: DataFrame) -> DataFrame:
    """Seasons of each league, newest first (distinct, so one entry per season)."""
    seasons = F.sort_array(F.collect_set("season"), asc=False)
    return standings.groupBy("league").agg(seasons.alias("seasons")).orderBy("league")


def resolve_season(standings: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """R2: the given season or the league's latest; no row for an unknown league."""
    if season:
        return standings.sparkSession.range(1).select(F.lit(season).alias("season"))
    return standings.filter(F.col("league") == league).agg(F.max("season").alias("season")).filter("season is not null")


def in_latest_season(df: DataFrame, season: str | None, among: DataFrame) -> DataFrame:
    """Rows of ``season``, or of the largest season found in ``among`` (a one-row aggregate)."""
    if season:
        return df.filter(F.col("season") == season)
    last = among.agg(F.max("season").alias("_last"))
    return with_one_row(df, last).filter(F.col("season") == F.col("_last")).drop("_last")


def _of_league(df: DataFrame, standings: DataFrame, league: str, season: str | None) -> DataFrame:
    mine = df.filter(F.col("league") == league)
    return in_latest_season(mine, season, standings.filter(F.col("league") == league))


def league_teams(standings: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """R3."""
    return _of_league(standings, standings, league, season).select(*TEAM_COLUMNS).distinct().orderBy("team_name")


def league_table(standings: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """R4."""
    return _of_league(standings, standings, league, season).orderBy("position")


def league_matches(results: DataFrame, standings: DataFrame, league: str, season: str | None = None) -> DataFrame:
    """R6."""
    return _of_league(results, standings, league, season).orderBy(F.col("utc_date").desc(), "source_match_id")


def _ranked_tables(teams: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Zero-filled records ranked inside each table."""
    rows = teams.join(stats, ["team_id", *keys], "left").fillna(0, subset=RECORD)
    return rank_within(cut_lineage(rows), keys, _table_order())


def standings_as_of(
    standings: DataFrame, by_matchday: DataFrame, moment: Column, league: str | None = None, season: str | None = None
) -> DataFrame:
    """The table of every (league, season) as it stood at ``moment``.

    Teams without a match by then appear with zeros. A date means its midnight, so that day's later
    matches are not counted. Restricting league and season is a filter, so both scans prune.
    """
    keys = ["league", "season"]
    given = {"league": league, "season": season}
    teams = optional_filters(standings, **given).select(*keys, *TEAM_COLUMNS).distinct()
    played = optional_filters(by_matchday, **given).filter(F.col("utc_date") <= moment)
    newest = [F.col("utc_date").desc(), F.col("source_match_id").desc()]
    stats = latest_per_key(played, [*keys, "team_id"], newest).select(*keys, "team_id", *RECORD)
    return _ranked_tables(teams, stats, keys).select(*keys, *TEAM_COLUMNS, "position", *RECORD)


def standings_from_results(
    standings: DataFrame, results: DataFrame, moment: Column, league: str | None = None, season: str | None = None
) -> DataFrame:
    """R5 for one moment straight from the matches: only those up to it are read, and summed before they are shuffled."""
    keys = ["league", "season"]
    given = {"league": league, "season": season}
    teams = optional_filters(standings, **given).select(*keys, *TEAM_COLUMNS).distinct()
    stats = records_until(optional_filters(results, **given), moment)
    return _ranked_tables(teams, stats, keys).select(*keys, *TEAM_COLUMNS, "position", *RECORD)


def standings_at_dates(standings: DataFrame, by_matchday: DataFrame, dates: DataFrame) -> DataFrame:
    """R5 for many moments in one job: ``dates`` lists ``(league, season, as_of)``."""
    keys = ["league", "season"]
    # both are read by the sample of the as-of join and again by its scan
    teams = cut_lineage(standings.select(*keys, *TEAM_COLUMNS).distinct())
    probes = cut_lineage(dates).join(teams, keys)
    facts = by_matchday.select(*keys, "team_id", "utc_date", "source_match_id", *RECORD)
    found = as_of_join(probes, facts, [*keys, "team_id"], "as_of", "utc_date", ["source_match_id"])
    tables = [*keys, "as_of"]
    filled = found.fillna(0, subset=RECORD).select(*tables, *TEAM_COLUMNS, *RECORD)
    ranked = rank_within(cut_lineage(filled), tables, _table_order())
    return ranked.select(*tables, *TEAM_COLUMNS, "position", *RECORD)


def recent_matches(results: DataFrame, league: str | None = None, limit: int = DEFAULT_TOP) -> DataFrame:
    """R7 / L2."""
    finished = optional_filters(results.filter(F.col("status") == FINISHED), league=league)
    return top_n(finished, [F.col("utc_date").desc_nulls_first(), F.col("source_match_id").asc()], limit, MAX_TOP)


def by_id(df: DataFrame, column: str, value) -> DataFrame:
    """R8 / F18."""
    return df.filter(F.col(column) == value)


def team_matches(results: DataFrame, team_id: int, season: str | None = None) -> DataFrame:
    """R9 / F11."""
    mine = (F.col("home_team_id") == team_id) | (F.col("away_team_id") == team_id)
    return optional_filters(results.filter(mine), season=season).orderBy(F.col("utc_date").desc(), "source_match_id")


def latest_team_form(form: DataFrame, team_id: int | None = None) -> DataFrame:
    """The newest season's form of one team, or of every team."""
    mine = optional_filters(form, team_id=team_id)
    return latest_per_key(mine, ["team_id"], [F.col("season").desc(), F.col("league").asc()])


def position_rank(c: Column | str) -> Column:
    """L4: squad order of a position, unknown ones last."""
    c = F.col(c) if isinstance(c, str) else c
    known = [F.when(c == name, F.lit(i + 1)) for i, name in enumerate(POSITION_ORDER)]
    return F.coalesce(*known, F.lit(len(POSITION_ORDER) + 1))


def team_squad(performance: DataFrame, profile: DataFrame, team_id: int, season: str | None = None) -> DataFrame:
    """Players a statistics source places at the team; the roster fallback is left out."""
    mine = performance.filter((F.col("team_id") == team_id) & (F.col("resolved_via") != FALLBACK))
    mine = in_latest_season(mine, season, performance)
    person = profile.select(
        "player_id", "player_name", "position", "nationality", "date_of_birth", "age", "shirt_number"
    )
    place = mine.select(
        "player_id", "team_id", "team_name", "league", "parent_team_id", "parent_team_name", "is_on_loan"
    )
    return person.join(place, "player_id").orderBy(
        position_rank("position"), F.col("shirt_number").asc_nulls_last(), "player_id"
    )


def top_players(
    performance: DataFrame,
    stat: str,
    league: str | None = None,
    team_id: int | None = None,
    season: str | None = None,
    limit: int = DEFAULT_TOP,
) -> DataFrame:
    """Leaders of ``stat`` ('goals' or 'assists'); NULL and 0 are not ranked."""
    counted = optional_filters(performance.filter(F.col(stat) > 0), league=league, team_id=team_id)
    counted = in_latest_season(counted, season, performance)
    return top_n(counted, [F.col(stat).desc_nulls_last(), F.col("player_name").asc(), F.col("player_id").asc()], limit, MAX_TOP)


def player_season(performance: DataFrame, player_id: int, season: str | None = None) -> DataFrame:
    """R13."""
    return in_latest_season(performance.filter(F.col("player_id") == player_id), season, performance)


def squad_groups(squad: DataFrame) -> DataFrame:
    """Squad rows with their position group and its place, kept as rows."""
    known = [F.when(F.col("position") == name, F.lit(name)) for name in POSITION_ORDER]
    return squad.withColumns(
        {"position_group": F.coalesce(*known, F.lit(NO_POSITION_GROUP)), "group_order": position_rank("position")}
    )


def squad_by_group(squad: DataFrame, keys: Sequence[str] = ("team_id",)) -> DataFrame:
    """One row per position group of each squad, in the fixed order of the groups, its players nested in squad order.

    A group holds a squad's players of one position, so its array stays short.
    """
    player = [c for c in squad.columns if c not in keys]
    order = [F.col("shirt_number").isNull(), F.col("shirt_number"), F.col("player_name"), F.col("player_id")]
    placed = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], F.struct(*player).alias("player"))
    grouped = squad_groups(squad).groupBy(*keys, "group_order", "position_group").agg(F.array_sort(F.collect_list(placed)).alias("placed"))
    players = F.transform("placed", lambda p: p["player"]).alias("players")
    return grouped.select(*keys, "group_order", "position_group", players).orderBy(*keys, "group_order")


def form_badges(form: DataFrame, column: str = "form") -> DataFrame:
    """R16."""
    return form.withColumn("letters", form_letters(column, FORM_LETTERS))
