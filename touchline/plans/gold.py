"""Marts (G1-G10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import CLOSED_STATUSES, FINISHED
from touchline.functions.dates import age_years
from touchline.functions.numbers import league_points
from touchline.functions.text import lower_trim
from touchline.operators.joins import join_role, unpivot_sides
from touchline.operators.ranking import latest_per_key, topk_per_key
from touchline.operators.scans import running_totals
from touchline.plans.silver import STANDING_COLUMNS

TEAM_SEASON = ["league", "season", "team_id"]
FORM_LENGTH = 5


def match_results(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Both team names next to each match."""
    named = join_role(matches, teams, "home_team_id", "team_id", {"home_team_name": "team_name"})
    named = join_role(named, teams, "away_team_id", "team_id", {"away_team_name": "team_name"})
    return named.select(
        "source_match_id", "league", "season", "matchday", "status", "utc_date", "home_team_id", "home_team_name",
        "away_team_id", "away_team_name", "home_score", "away_score",
    )


def league_standings(standings: DataFrame, teams: DataFrame, secondary_standings: DataFrame) -> DataFrame:
    """G1: standings with team names and the secondary source's newest expected-goal columns."""
    xg = latest_per_key(
        secondary_standings.filter("team_id is not null"),
        TEAM_SEASON,
        [F.col("ingestion_time").desc(), F.col("xg").asc(), F.col("xga").asc(), F.col("xpts").asc()],
    ).select(*TEAM_SEASON, "xg", "xga", "xpts")
    names = teams.select("team_id", "team_name", "team_short_name", "team_tla")
    return (
        standings.join(xg, TEAM_SEASON, "left")
        .join(names, "team_id")
        .select(*TEAM_SEASON, "team_name", "team_short_name", "team_tla", *STANDING_COLUMNS, "xg", "xga", "xpts")
    )


def season_in_progress(match_results_df: DataFrame) -> DataFrame:
    """(league, season) pairs with a match still open; a NULL status does not count as open."""
    return match_results_df.filter(~F.col("status").isin(*CLOSED_STATUSES)).select("league", "season").distinct()


def _loan_flag(team: str, parent: str) -> Column:
    differs = ~F.col(team).eqNullSafe(F.col(parent))
    return (F.col(parent).isNotNull() & differs & F.col("_open").isNotNull()).alias("is_on_loan")


def _with_open_season(df: DataFrame, open_seasons: DataFrame, season: str = "season") -> DataFrame:
    flag = open_seasons.select(F.col("league").alias("_l"), F.col("season").alias("_s"), F.lit(True).alias("_open"))
    return df.join(flag, (df["league"] == flag["_l"]) & (df[season] == flag["_s"]), "left").drop("_l", "_s")


def player_performance(
    player_team_season: DataFrame, players: DataFrame, teams: DataFrame, match_results_df: DataFrame
) -> DataFrame:
    """G4."""
    rows = player_team_season.join(players.select("player_id", "player_name"), "player_id")
    rows = join_role(rows, teams, "team_id", "team_id", {"team_name": "team_name"})
    rows = join_role(rows, teams, "parent_team_id", "team_id", {"parent_team_name": "team_name"})
    rows = _with_open_season(rows, season_in_progress(match_results_df))
    return rows.select(
        "player_id", "player_name", "season", "team_id", "team_name", "league", "resolved_via", "parent_team_id",
        "parent_team_name", _loan_flag("team_id", "parent_team_id"),
        F.coalesce("statbunker_goals", "understat_goals").alias("goals"),
        "assists", "apps", "minutes", "xg", "xa", "xg90", "xa90",
    )


def player_profile(
    players: DataFrame,
    player_team_season: DataFrame,
    teams: DataFrame,
    match_results_df: DataFrame,
    today: Column | None = None,
) -> DataFrame:
    """One row per player with the team of the latest season."""
    last = latest_per_key(player_team_season, ["player_id"], [F.col("season").desc_nulls_first()]).select(
        "player_id", F.col("team_id").alias("last_team"), "parent_team_id", F.col("season").alias("last_season"),
        F.col("league").alias("last_league"),
    )
    rows = players.drop("ingestion_time").join(last, "player_id", "left")
    rows = rows.drop("team_id").withColumnRenamed("last_team", "team_id").withColumnRenamed("league", "base_league")
    rows = rows.withColumnRenamed("last_league", "league")
    rows = join_role(rows, teams, "team_id", "team_id", {"team_name": "team_name"})
    rows = join_role(rows, teams, "parent_team_id", "team_id", {"parent_team_name": "team_name"})
    rows = _with_open_season(rows, season_in_progress(match_results_df), "last_season")
    return rows.select(
        "player_id", "player_name", "position", "nationality", "date_of_birth",
        age_years("date_of_birth", today).alias("age"), "shirt_number", "team_id", "team_name", "parent_team_id",
        "parent_team_name", _loan_flag("team_id", "parent_team_id"),
        F.coalesce("league", "base_league").alias("league"),
    )


def _outcome(own: Column, other: Column, win, draw, loss) -> Column:
    """A NULL score compares as unknown and falls to the last branch."""
    return F.when(own > other, win).when(own == other, draw).otherwise(loss)


def _sides(matches: DataFrame, shared: list[str], outcome) -> DataFrame:
    home, away = F.col("home_score"), F.col("away_score")
    return unpivot_sides(
        matches,
        shared,
        [
            {"team_id": F.col("home_team_id"), "goals_for": home, "goals_against": away, **outcome(home, away)},
            {"team_id": F.col("away_team_id"), "goals_for": away, "goals_against": home, **outcome(away, home)},
        ],
    )


def team_form(matches: DataFrame, teams: DataFrame, last: int = FORM_LENGTH) -> DataFrame:
    """Totals and form string over each team's last finished matches of a season.

    At most ``last`` rows per team reach the aggregation, so the ordered string is bounded.
    """

    def outcome(own: Column, other: Column) -> dict[str, Column]:
        return {
            "result": _outcome(own, other, F.lit("W"), F.lit("D"), F.lit("L")),
            "points": _outcome(own, other, F.lit(3), F.lit(1), F.lit(0)),
        }

    finished = matches.filter(F.col("status") == FINISHED)
    sides = _sides(finished, ["league", "season", "utc_date", "source_match_id"], outcome)
    newest = [F.col("utc_date").desc_nulls_first(), F.col("source_match_id").desc()]
    recent = topk_per_key(sides, TEAM_SEASON, newest, last)
    folded = recent.groupBy(*TEAM_SEASON).agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.count_if(F.col("result") == "W").alias("wins"),
        F.count_if(F.col("result") == "D").alias("draws"),
        F.count_if(F.col("result") == "L").alias("losses"),
        F.sum("points").alias("points"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "result"))), lambda s: s["result"]), ""
        ).alias("form"),
    )
    return folded.join(teams.select("team_id", "team_name"), "team_id").select(
        *TEAM_SEASON, "team_name", *[c for c in folded.columns if c not in TEAM_SEASON]
    )


MEASURES = ["won", "draw", "lost", "points", "goals_for", "goals_against"]


def _played_sides(finished: DataFrame) -> DataFrame:
    """Two rows per match with what it adds to a team's record; NULL scores add no win, draw or loss."""

    def outcome(own: Column, other: Column) -> dict[str, Column]:
        return {
            "won": F.coalesce((own > other).cast("int"), F.lit(0)),
            "draw": F.coalesce((own == other).cast("int"), F.lit(0)),
            "lost": F.coalesce((own < other).cast("int"), F.lit(0)),
        }

    sides = _sides(finished, ["league", "season", "source_match_id", "utc_date"], outcome)
    return sides.withColumn("points", league_points("won", "draw"))


def standings_by_matchday(match_results_df: DataFrame) -> DataFrame:
    """Cumulative record of each team after each finished match.

    NULL scores count as played with no win, draw or loss. Pass a materialised table: the scan also samples it.
    """
    totals = running_totals(
        _played_sides(match_results_df.filter(F.col("status") == FINISHED)).withColumnsRenamed({m: f"_{m}" for m in MEASURES}),
        TEAM_SEASON,
        [F.col("utc_date").isNull(), F.col("utc_date"), F.col("source_match_id")],
        sums={m: f"_{m}" for m in MEASURES},
        row_number="played_games",
    )
    return totals.select(
        *TEAM_SEASON, "source_match_id", "utc_date", "played_games", *MEASURES,
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
    )


def records_until(match_results_df: DataFrame, moment: Column) -> DataFrame:
    """The record of each team at ``moment``: what the last row of ``standings_by_matchday`` up to it says, as one aggregate."""
    finished = match_results_df.filter((F.col("status") == FINISHED) & (F.col("utc_date") <= moment))
    summed = _played_sides(finished).groupBy(*TEAM_SEASON).agg(
        F.count(F.lit(1)).alias("played_games"), *[F.sum(m).alias(m) for m in MEASURES])
    return summed.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))


def standings_history(snapshot: DataFrame, teams: DataFrame) -> DataFrame:
    """G8."""
    names = teams.select("team_id", "team_name", "team_short_name", "team_tla")
    return snapshot.join(names, "team_id").select(
        *TEAM_SEASON, "team_name", "team_short_name", "team_tla", *STANDING_COLUMNS, "valid_from", "valid_to"
    )


def team_profile(teams: DataFrame) -> DataFrame:
    """G9."""
    return teams.select("team_id", "team_name", "team_short_name", "team_tla", "league")


def search_aliases(seed: DataFrame) -> DataFrame:
    """G10."""
    return seed.select("entity_type", lower_trim("alias").alias("alias"), "entity_id")
