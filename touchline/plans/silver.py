"""Deduplicated entities and cross-source resolution.

The reference order for "latest" is the ingestion time alone; ties are settled here by further
columns so that a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import FALLBACK, PRIMARY, SECONDARY, SECONDARY_ID_OFFSET, TERTIARY
from touchline.functions.text import normalize_name, unescape_apostrophe
from touchline.operators.joins import first_match, union_distinct, with_one_row
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key, pick_by_priority, unique_name_index


def _newest(df: DataFrame, keys: list[str], *ties: str) -> DataFrame:
    order = [F.col("ingestion_time").desc(), *[F.col(c).asc_nulls_last() for c in ties]]
    return latest_per_key(df, keys, order)


def matches(staged: DataFrame) -> DataFrame:
    """V1."""
    ties = ("status", "utc_date", "home_team_id", "away_team_id", "home_score", "away_score")
    return _newest(staged, ["source_match_id"], *ties).select(
        F.lit(PRIMARY).alias("source"), "source_match_id", "league", "season", "matchday", "status", "utc_date",
        "home_team_id", "away_team_id", "home_score", "away_score",
    )


STANDING_COLUMNS = [
    "position", "played_games", "won", "draw", "lost", "points", "goals_for", "goals_against",
    "goal_difference", "form",
]


def standings(staged: DataFrame) -> DataFrame:
    """V2."""
    keys = ["league", "season", "team_id"]
    return _newest(staged, keys, *STANDING_COLUMNS).select(*keys, *STANDING_COLUMNS, "ingestion_time")


def teams(staged_standings: DataFrame, latest_only: bool = False) -> DataFrame:
    """V3: distinct team attributes over all snapshots (a renamed team gives two rows).

    ``latest_only`` keeps one row per team, from its newest snapshot.
    """
    attrs = ["team_id", "team_name", "team_short_name", "team_tla", "league"]
    known = staged_standings.filter("team_id is not null")
    if latest_only:
        return _newest(known, ["team_id"], *attrs[1:]).select(*attrs)
    return known.select(*attrs).distinct()


def _name_map(player_name_map: DataFrame, source: str) -> DataFrame:
    return player_name_map.filter(F.col("source") == source)


def players(
    primary: DataFrame,
    secondary: DataFrame,
    player_name_map: DataFrame,
    extra_info: DataFrame,
    display_names: DataFrame,
) -> DataFrame:
    """V4: primary players plus the secondary ones that match none of them.

    A secondary player matches through the curated map or through a normalised name that belongs
    to exactly one primary player; the comparison uses the primary name before any display override.
    """
    known = _newest(primary.filter("player_id is not null"), ["player_id"], "team_id", "player_name")
    extra = extra_info.select(
        "player_id", F.col("nationality").alias("x_nat"), F.col("date_of_birth").alias("x_dob"),
        F.col("shirt_number").alias("x_shirt"),
    )
    base = (
        known.join(display_names.select("player_id", "display_name"), "player_id", "left")
        .join(extra, "player_id", "left")
        .select(
            "player_id",
            F.coalesce("display_name", "player_name").alias("player_name"),
            "position",
            F.coalesce("date_of_birth", "x_dob").alias("date_of_birth"),
            F.coalesce("nationality", "x_nat").alias("nationality"),
            F.coalesce("shirt_number", "x_shirt").alias("shirt_number"),
            "team_id",
            "league",
            "ingestion_time",
        )
    )
    by_name = unique_name_index(known, normalize_name("player_name"), "player_id")
    other = _newest(
        secondary.filter("understat_id is not null"), ["understat_id"], "season", "team_id", "raw_player_name"
    ).withColumn("raw_player_name", unescape_apostrophe("raw_player_name"))
    matched = first_match(
        other,
        [
            (
                _name_map(player_name_map, SECONDARY),
                {"raw_player_name": F.col("raw_player_name"), "team_id": F.col("team_id")},
                "player_id",
            ),
            (by_name, {"norm_name": normalize_name("raw_player_name")}, "player_id"),
        ],
        "match_id",
    )
    only = (
        matched.filter("match_id is null")
        .withColumn("player_id", F.col("understat_id") + SECONDARY_ID_OFFSET)
        .join(extra, "player_id", "left")
        .select(
            "player_id",
            F.col("raw_player_name").alias("player_name"),
            "position",
            F.col("x_dob").alias("date_of_birth"),
            F.col("x_nat").alias("nationality"),
            F.col("x_shirt").alias("shirt_number"),
            F.lit(None).cast("int").alias("team_id"),
            "league",
            "ingestion_time",
        )
    )
    return base.unionByName(only)


def _player_lookups(players_df: DataFrame, player_name_map: DataFrame, source: str, by_id: Column | None):
    lookups = [
        (
            _name_map(player_name_map, source),
            {"raw_player_name": F.col("raw_player_name"), "team_id": F.col("team_id")},
            "player_id",
        )
    ]
    if by_id is not None:
        lookups.append((players_df.select("player_id"), {"player_id": by_id}, "player_id"))
    by_name = unique_name_index(players_df, normalize_name("player_name"), "player_id")
    lookups.append((by_name, {"norm_name": normalize_name("raw_player_name")}, "player_id"))
    return lookups


def resolve_secondary(secondary: DataFrame, players_df: DataFrame, player_name_map: DataFrame) -> DataFrame:
    """V6 before deduplication: map, then offset id, then unique name; NULL when none hits."""
    by_id = F.col("understat_id") + SECONDARY_ID_OFFSET
    return first_match(secondary, _player_lookups(players_df, player_name_map, SECONDARY, by_id), "player_id")


def resolve_tertiary(tertiary: DataFrame, players_df: DataFrame, player_name_map: DataFrame) -> DataFrame:
    """V7 before deduplication: map, then unique name."""
    return first_match(tertiary, _player_lookups(players_df, player_name_map, TERTIARY, None), "player_id")


def match_secondary(secondary: DataFrame, players_df: DataFrame, player_name_map: DataFrame) -> DataFrame:
    """V6: latest resolved row per (player, season)."""
    hit = resolve_secondary(secondary, players_df, player_name_map).filter("player_id is not null")
    return _newest(hit, ["player_id", "season"], "understat_id", "team_id", "goals")


def match_tertiary(tertiary: DataFrame, players_df: DataFrame, player_name_map: DataFrame) -> DataFrame:
    """V7: latest resolved row per (player, season)."""
    hit = resolve_tertiary(tertiary, players_df, player_name_map).filter("player_id is not null")
    return _newest(hit, ["player_id", "season"], "raw_player_name", "team_id", "goals")


def season_universe(secondary_latest: DataFrame, tertiary_latest: DataFrame) -> DataFrame:
    """V8."""
    return union_distinct(secondary_latest.select("season").distinct(), tertiary_latest.select("season").distinct())


def current_season(seasons: DataFrame) -> DataFrame:
    """V8: one row, the lexically largest season."""
    return seasons.agg(F.max("season").alias("season"))


def roster_fallback(players_df: DataFrame, current: DataFrame) -> DataFrame:
    """V9: today's roster stands in for the current season only."""
    roster = players_df.filter("team_id is not null").select("player_id", "league", "team_id")
    return with_one_row(roster, current).select("player_id", "season", "league", "team_id")


def resolve_by_priority(secondary_latest: DataFrame, tertiary_latest: DataFrame, fallback: DataFrame) -> DataFrame:
    """The best-placed source with a team decides team and league of a (player, season)."""
    columns = ["player_id", "season", "league", "team_id"]

    def tagged(df: DataFrame, priority: int, label: str) -> DataFrame:
        return df.filter("team_id is not null").select(
            *columns, F.lit(priority).alias("source_priority"), F.lit(label).alias("resolved_via")
        )

    candidates = (
        tagged(secondary_latest, 1, SECONDARY)
        .unionByName(tagged(tertiary_latest, 2, TERTIARY))
        .unionByName(tagged(fallback, 3, FALLBACK))
    )
    return pick_by_priority(candidates, ["player_id", "season"], "source_priority").drop("source_priority")


def source_disagreement(secondary_latest: DataFrame, tertiary_latest: DataFrame) -> DataFrame:
    """Both sources know the (player, season); do their teams differ (NULL-safe)?"""
    a = secondary_latest.select("player_id", "season", F.col("team_id").alias("a"))
    b = tertiary_latest.select("player_id", "season", F.col("team_id").alias("b"))
    return a.join(b, ["player_id", "season"]).select(
        "player_id", "season", (~F.col("a").eqNullSafe(F.col("b"))).alias("source_disagreement")
    )


def player_team_season(
    players_df: DataFrame, secondary: DataFrame, tertiary: DataFrame, player_name_map: DataFrame
) -> DataFrame:
    """One row per (player, season) with team, provenance and the stats of both sources.

    The sources hold at most one row per (player, season), so V10's priority pick is two full outer
    joins on that key instead of a union and a window. The joined statistics are materialised
    once: they give the current season and the rows. Pass a materialised ``players`` table, it is
    read for ids, names and rosters.
    """
    keys = ["player_id", "season"]
    sec = match_secondary(secondary, players_df, player_name_map).select(
        *keys, F.struct("team_id", "league", "apps", "minutes", "goals", "assists", "xg", "xa", "xg90", "xa90").alias("s")
    )
    ter = match_tertiary(tertiary, players_df, player_name_map).select(
        *keys, F.struct("team_id", "league", "goals").alias("t")
    )
    stats = cut_lineage(sec.join(ter, keys, "full_outer"))
    roster = roster_fallback(players_df, current_season(stats)).select(*keys, F.struct("team_id", "league").alias("f"))
    joined = stats.join(roster, keys, "full_outer")
    by_source = [("s", SECONDARY), ("t", TERTIARY), ("f", FALLBACK)]

    def winner(value) -> Column:
        return F.coalesce(*[F.when(F.col(f"{c}.team_id").isNotNull(), value(c, label)) for c, label in by_source])

    registered = players_df.select("player_id", F.col("team_id").alias("parent_team_id"))
    both = F.col("s").isNotNull() & F.col("t").isNotNull()
    resolved = joined.select(
        *keys,
        winner(lambda c, label: F.col(f"{c}.league")).alias("league"),
        winner(lambda c, label: F.col(f"{c}.team_id")).alias("team_id"),
        winner(lambda c, label: F.lit(label)).alias("resolved_via"),
        (both & ~F.col("s.team_id").eqNullSafe(F.col("t.team_id"))).alias("source_disagreement"),
        "s.apps", "s.minutes", F.col("s.goals").alias("understat_goals"), "s.assists", "s.xg", "s.xa", "s.xg90",
        "s.xa90", F.col("t.goals").alias("statbunker_goals"),
    ).filter("team_id is not null")
    return resolved.join(registered, "player_id", "left")
