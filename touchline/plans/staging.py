"""Bronze documents to typed rows.

Every model filters bronze on its partition columns, parses the payload once against a declared
schema (unread fields are never built) and explodes; a missing or empty array gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.constants import PRIMARY, SECONDARY, TERTIARY
from touchline.functions.dates import wall_clock
from touchline.functions.numbers import DECIMAL, per90, sentinel_int
from touchline.functions.text import normalize_position
from touchline.operators.joins import without

CARRIED = ["season", "league", "ingestion_time"]


def _documents(bronze: DataFrame, source: str, entity_type: str, payload_schema: str) -> DataFrame:
    docs = bronze.filter((F.col("source") == source) & (F.col("entity_type") == entity_type))
    return docs.select(*CARRIED, F.from_json("payload", payload_schema).alias("doc"))


def _rows(docs: DataFrame, array: Column, *parent: Column) -> DataFrame:
    return docs.select(*CARRIED, *parent, F.explode(array).alias("r"))


def _typed(rows: DataFrame, fields: Mapping[str, tuple[str, str]], *more: Column) -> DataFrame:
    cols = [F.col("r." + path).cast(kind).alias(out) for out, (path, kind) in fields.items()]
    return rows.select(*CARRIED, *more, *cols)


def _with_team(rows: DataFrame, team_name_map: DataFrame, source: str, raw: Column) -> DataFrame:
    """Left join the (source, raw team name) map (K5); the map has unique keys."""
    named = rows.withColumn("_raw", raw)
    side = team_name_map.filter(F.col("source") == source).select("raw_team_name", F.col("team_id").alias("mapped_team_id"))
    return named.join(side, named["_raw"] == side["raw_team_name"], "left").drop("_raw", "raw_team_name")


def primary_matches(bronze: DataFrame) -> DataFrame:
    """J1."""
    docs = _documents(bronze, PRIMARY, "matches", schemas.MATCHES_PAYLOAD)
    rows = _rows(docs, F.col("doc.matches"))
    return rows.select(
        *CARRIED,
        F.col("r.id").cast("int").alias("source_match_id"),
        F.col("r.matchday").cast("int").alias("matchday"),
        "r.status",
        wall_clock("r.utcDate").alias("utc_date"),
        F.col("r.homeTeam.id").cast("int").alias("home_team_id"),
        F.col("r.awayTeam.id").cast("int").alias("away_team_id"),
        F.col("r.score.fullTime.home").cast("int").alias("home_score"),
        F.col("r.score.fullTime.away").cast("int").alias("away_score"),
    )


def primary_players(bronze: DataFrame) -> DataFrame:
    """The squad's team id is repeated on every player."""
    docs = _documents(bronze, PRIMARY, "players", schemas.SQUAD_PAYLOAD)
    rows = _rows(docs, F.col("doc.squad"), F.col("doc.id").cast("int").alias("team_id"))
    fields = {
        "player_id": ("id", "int"), "player_name": ("name", "string"), "position": ("position", "string"),
        "date_of_birth": ("dateOfBirth", "date"), "nationality": ("nationality", "string"),
        "shirt_number": ("shirtNumber", "int"),
    }
    return _typed(rows, fields, F.col("team_id"))


def _total_rows(bronze: DataFrame) -> DataFrame:
    docs = _documents(bronze, PRIMARY, "standings", schemas.STANDINGS_PAYLOAD)
    total = F.filter("doc.standings", lambda b: b["type"] == "TOTAL")
    blocks = docs.select(*CARRIED, F.explode(total).alias("b"))
    return blocks.select(*CARRIED, F.explode("b.table").alias("r"))


def primary_standings(bronze: DataFrame) -> DataFrame:
    """Only the TOTAL block, one row per team."""
    fields = {
        "team_id": ("team.id", "int"), "team_name": ("team.name", "string"),
        "team_short_name": ("team.shortName", "string"), "team_tla": ("team.tla", "string"),
        "position": ("position", "int"), "played_games": ("playedGames", "int"), "won": ("won", "int"),
        "draw": ("draw", "int"), "lost": ("lost", "int"), "points": ("points", "int"),
        "goals_for": ("goalsFor", "int"), "goals_against": ("goalsAgainst", "int"),
        "goal_difference": ("goalDifference", "int"), "form": ("form", "string"),
    }
    return _typed(_total_rows(bronze), fields)


def primary_team_ids(bronze: DataFrame) -> DataFrame:
    """Team ids of the TOTAL block, missing ids dropped."""
    return _total_rows(bronze).select(*CARRIED, F.col("r.team.id").cast("int").alias("team_id")).filter("team_id is not null")


def tertiary_player_stats(bronze: DataFrame, team_name_map: DataFrame) -> DataFrame:
    """J5."""
    rows = _rows(_documents(bronze, TERTIARY, "player_stats", schemas.TERTIARY_PLAYERS_PAYLOAD), F.col("doc"))
    mapped = _with_team(rows, team_name_map, TERTIARY, F.col("r.team"))
    counts = [sentinel_int(F.col("r." + c)).alias(c) for c in ("goals", "fh", "sh", "fs", "ls", "h", "a")]
    return mapped.select(
        *CARRIED, F.col("mapped_team_id").alias("team_id"), F.col("r.player").alias("raw_player_name"), *counts
    )


_TABLE_COUNTS = ("rank", "played", "wins", "draws", "losses", "goals_for", "goals_against")


def tertiary_standings(bronze: DataFrame, team_name_map: DataFrame) -> DataFrame:
    """J6."""
    rows = _rows(_documents(bronze, TERTIARY, "standings", schemas.TERTIARY_STANDINGS_PAYLOAD), F.col("doc"))
    mapped = _with_team(rows, team_name_map, TERTIARY, F.col("r.team"))
    fields = {c: (c, "int") for c in (*_TABLE_COUNTS, "goal_diff", "points")}
    return _typed(mapped, fields, F.col("r.team").alias("raw_team_name"), F.col("mapped_team_id").alias("team_id"))


def secondary_standings(bronze: DataFrame, team_name_map: DataFrame) -> DataFrame:
    """J7."""
    rows = _rows(_documents(bronze, SECONDARY, "standings", schemas.SECONDARY_STANDINGS_PAYLOAD), F.col("doc"))
    mapped = _with_team(rows, team_name_map, SECONDARY, F.col("r.team"))
    fields = {c: (c, "int") for c in (*_TABLE_COUNTS, "points")}
    fields |= {"xg": ("xG", DECIMAL), "xga": ("xGA", DECIMAL), "xpts": ("xPTS", DECIMAL)}
    return _typed(mapped, fields, F.col("r.team").alias("raw_team_name"), F.col("mapped_team_id").alias("team_id"))


def secondary_player_stats(
    bronze: DataFrame, team_name_map: DataFrame, team_override: DataFrame, exclusion: DataFrame
) -> DataFrame:
    """A joined team title (several clubs) only resolves through the per-season override."""
    rows = _rows(_documents(bronze, SECONDARY, "player_stats", schemas.SECONDARY_PLAYERS_PAYLOAD), F.col("doc"))
    rows = rows.withColumn("understat_id", F.col("r.id").cast("int"))
    rows = without(rows, exclusion, ["understat_id", "season"])
    fixed = team_override.select("understat_id", "season", F.col("team_id").alias("fixed_team_id"))
    rows = rows.join(fixed, ["understat_id", "season"], "left")
    mapped = _with_team(rows, team_name_map, SECONDARY, F.trim("r.team_title"))
    single = F.when(~F.coalesce(F.col("r.team_title").contains(","), F.lit(False)), F.col("mapped_team_id"))
    fields = {
        "apps": ("games", "int"), "minutes": ("time", "int"), "goals": ("goals", "int"),
        "assists": ("assists", "int"), "xg": ("xG", DECIMAL), "xa": ("xA", DECIMAL),
    }
    typed = _typed(
        mapped,
        fields,
        F.coalesce("fixed_team_id", single).alias("team_id"),
        F.col("r.player_name").alias("raw_player_name"),
        F.col("understat_id"),
        normalize_position("r.position").alias("position"),
    )
    return typed.withColumns({"xg90": per90("xg", "minutes"), "xa90": per90("xa", "minutes")})
