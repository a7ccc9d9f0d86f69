"""Declared schemas: payload shapes, bronze and operational tables, reference files."""

from __future__ import annotations

MATCHES_PAYLOAD = (
    "matches ARRAY<STRUCT<id:STRING,matchday:STRING,status:STRING,utcDate:STRING,homeTeam:STRUCT<id:STRING>,"
    "awayTeam:STRUCT<id:STRING>,score:STRUCT<fullTime:STRUCT<home:STRING,away:STRING>>>>"
)
SQUAD_PAYLOAD = (
    "id STRING, squad ARRAY<STRUCT<id:STRING,name:STRING,position:STRING,dateOfBirth:STRING,"
    "nationality:STRING,shirtNumber:STRING>>"
)
STANDINGS_PAYLOAD = (
    "standings ARRAY<STRUCT<type:STRING,table:ARRAY<STRUCT<position:STRING,"
    "team:STRUCT<id:STRING,name:STRING,shortName:STRING,tla:STRING>,playedGames:STRING,form:STRING,won:STRING,"
    "draw:STRING,lost:STRING,points:STRING,goalsFor:STRING,goalsAgainst:STRING,goalDifference:STRING>>>>"
)
TERTIARY_STANDINGS_PAYLOAD = (
    "ARRAY<STRUCT<rank:STRING,team:STRING,club_id:STRING,played:STRING,wins:STRING,draws:STRING,"
    "losses:STRING,goals_for:STRING,goals_against:STRING,goal_diff:STRING,points:STRING>>"
)
TERTIARY_PLAYERS_PAYLOAD = (
    "ARRAY<STRUCT<player:STRING,goals:STRING,fh:STRING,sh:STRING,fs:STRING,ls:STRING,h:STRING,a:STRING,"
    "team:STRING>>"
)
SECONDARY_STANDINGS_PAYLOAD = (
    "ARRAY<STRUCT<rank:STRING,team:STRING,played:STRING,wins:STRING,draws:STRING,losses:STRING,"
    "goals_for:STRING,goals_against:STRING,points:STRING,xG:STRING,xGA:STRING,xPTS:STRING>>"
)
SECONDARY_PLAYERS_PAYLOAD = (
    "ARRAY<STRUCT<id:STRING,player_name:STRING,team_title:STRING,games:STRING,time:STRING,goals:STRING,"
    "assists:STRING,xG:STRING,xA:STRING,position:STRING>>"
)

BRONZE = (
    "source STRING, entity_type STRING, entity_id STRING, payload STRING, source_url STRING, "
    "content_hash STRING, ingestion_time TIMESTAMP, season STRING, league STRING"
)
TRACKING = (
    "file_path STRING, source STRING, entity_type STRING, mtime TIMESTAMP, size_bytes BIGINT, ingested_at TIMESTAMP"
)
CHAT_LOG = (
    "conversation_id STRING, user_message STRING, model STRING, sql_generated STRING, response STRING, "
    "prompt_tokens INT, completion_tokens INT, latency_ms INT, cost_estimate_usd DECIMAL(10,6), created_at TIMESTAMP"
)

SEEDS = {
    "team_name_map": "source STRING, raw_team_name STRING, team_id INT",
    "player_name_map": "source STRING, raw_player_name STRING, team_id INT, player_id INT",
    "player_extra_info": "player_id INT, nationality STRING, date_of_birth DATE, shirt_number INT",
    "player_display_name_overrides": "player_id INT, display_name STRING",
    "understat_transfer_team_override": (
        "understat_id INT, season STRING, player_name STRING, team_id INT, team_name STRING"
    ),
    "understat_player_exclusion": "understat_id INT, season STRING, player_name STRING, reason STRING",
    "search_aliases_seed": "entity_type STRING, alias STRING, entity_id INT",
}
