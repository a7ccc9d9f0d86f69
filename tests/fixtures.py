"""A small crawl: raw files of three sources, reference tables, and the bronze they give."""

import json
import os

from touchline import schemas
from touchline.sources import bronze, files


def match(i, status, date, home, away, hs, as_, day=1):
    return {
        "id": i, "matchday": day, "status": status, "utcDate": date, "homeTeam": {"id": home}, "awayTeam": {"id": away},
        "score": {"fullTime": {"home": hs, "away": as_}},
    }


def row(pos, team, name, played=3, **more):
    base = {
        "position": pos, "team": {"id": team, "name": name, "shortName": name[:3], "tla": name[:3].upper()}, "playedGames": played,
        "form": "W", "won": 1, "draw": 1, "lost": 1, "points": 4, "goalsFor": 3, "goalsAgainst": 3, "goalDifference": 0,
    }
    return base | more


MATCHES = [
    match(1, "FINISHED", "2025-08-16T14:00:00Z", 57, 65, 2, 0),
    match(2, "FINISHED", "2025-08-17T14:00:00Z", 66, 57, 1, 1),
    match(3, "FINISHED", "2025-08-23T14:00:00Z", 65, 66, 0, 3),
    match(4, "FINISHED", "2025-08-24T14:00:00Z", 57, 66, None, None),  # no score: 'L' in form, 0/0/0 in the running table
    match(5, "AWARDED", "2025-08-30T14:00:00Z", 65, 57, 3, 0),
    match(6, "SCHEDULED", "2025-09-01T14:00:00Z", 57, 65, None, None),
]
STANDINGS = {"standings": [
    {"type": "TOTAL", "table": [row(1, 57, "Arsenal FC"), row(2, 66, "Manchester United FC"), row(3, 65, "Manchester City FC")]},
    {"type": "HOME", "table": [row(1, 999, "Nobody")]},
]}


def player(i, name, position="Defence", born="1999-01-02", nation="X", shirt=5):
    return {"id": i, "name": name, "position": position, "dateOfBirth": born, "nationality": nation, "shirtNumber": shirt}


SQUADS = {
    57: [player(10, "Eberechi Eze"), player(11, "Idrissa Gueye"), player(12, "Bukayo Saka", "Offence", None, None, None)],
    65: [player(20, "Sávio Moreira"), player(21, "Idrissa Gueye")],
    66: [],
}
SECONDARY_PLAYERS = [
    {"id": "900", "player_name": "Eberechi Eze", "team_title": "Arsenal,Crystal Palace", "games": "3", "time": "270", "goals": "2", "assists": "1", "xG": "1.5", "xA": "0.3", "position": "F S"},
    {"id": "901", "player_name": "Jun&#039;ai Byfield", "team_title": " Manchester United ", "games": "1", "time": "0", "goals": "0", "assists": "0", "xG": "0.1", "xA": "0", "position": "GK"},
    {"id": "902", "player_name": "Idrissa Gueye", "team_title": "Manchester City", "games": "2", "time": "90", "goals": "1", "assists": "0", "xG": "0.5", "xA": "0", "position": "M"},
    {"id": "903", "player_name": "Ghost", "team_title": "Arsenal", "games": "1", "time": "90", "goals": "9", "assists": "9", "xG": "9", "xA": "9", "position": "S"},
    {"id": "904", "player_name": "Bukayo Saka", "team_title": "Manchester United", "games": "3", "time": "200", "goals": "1", "assists": "2", "xG": "0.4", "xA": "0.6", "position": "F"},
    {"id": "905", "player_name": "Nowhere Man", "team_title": "A,B", "games": "3", "time": "10", "goals": "0", "assists": "0", "xG": "0", "xA": "0", "position": "D"},
]
TERTIARY_PLAYERS = [
    {"player": "E. Eze", "goals": "3", "fh": "-", "sh": "1", "fs": "-", "ls": "-", "h": "1", "a": "-", "team": "Arsenal"},
    {"player": "Bukayo Saka", "goals": "-", "fh": "-", "sh": "-", "fs": "-", "ls": "-", "h": "-", "a": "-", "team": "Arsenal"},
    {"player": "Unknown Person", "goals": "1", "fh": "-", "sh": "-", "fs": "-", "ls": "-", "h": "-", "a": "-", "team": "Lost FC"},
]


def put(root, path, data):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8") as f:
        f.write(data if isinstance(data, str) else json.dumps(data, ensure_ascii=False, indent=2))


def write_crawl(root):
    fdo, sb, us = "football_data_org", "statbunker", "understat"
    put(root, f"{fdo}/matches/2025-09-01/PL_2025_120000_000001.json", {"matches": MATCHES})
    put(root, f"{fdo}/standings/2025-09-01/PL_2025_120000_000002.json", STANDINGS)
    for team, squad in SQUADS.items():
        put(root, f"{fdo}/players/2025-09-01/PL_2025_{team}_120000_00000{team}.json", {"id": team, "squad": squad})
    put(root, f"{us}/player_stats/2025-09-01/EPL_2025-2026_120000_000003.json", SECONDARY_PLAYERS)
    put(root, f"{us}/standings/2025-09-01/EPL_2025-2026_120000_000004.json", [
        {"rank": "1", "team": "Arsenal", "played": "3", "wins": "1", "draws": "1", "losses": "1", "goals_for": "3", "goals_against": "3", "points": "4", "xG": "4.25", "xGA": "2.5", "xPTS": "6.1"},
        {"rank": "2", "team": "Mystery Club", "played": "3", "wins": "1", "draws": "1", "losses": "1", "goals_for": "3", "goals_against": "3", "points": "4", "xG": "1", "xGA": "1", "xPTS": "1"},
    ])
    put(root, f"{sb}/player_stats/2025-09-01/PL_2025_77_120000_000005.json", TERTIARY_PLAYERS)
    put(root, f"{sb}/standings/2025-09-01/PL_2025_120000_000006.json", [
        {"rank": "1", "team": "Arsenal", "club_id": "77", "played": "3", "wins": "1", "draws": "1", "losses": "1", "goals_for": "3", "goals_against": "3", "goal_diff": "0", "points": "4"},
    ])


def seeds(spark):
    def make(name, data):
        return spark.createDataFrame(data, schemas.SEEDS[name])

    clubs = [("Arsenal", 57), ("Manchester City", 65), ("Manchester United", 66)]
    return {
        "team_name_map": make("team_name_map", [(s, n, i) for s in ("statbunker", "understat") for n, i in clubs]),
        "player_name_map": make("player_name_map", [("statbunker", "E. Eze", 57, 10)]),
        "player_extra_info": spark.sql("SELECT 12 AS player_id, 'England' AS nationality, DATE '2001-09-05' AS date_of_birth, 7 AS shirt_number"),
        "player_display_name_overrides": make("player_display_name_overrides", [(20, "Savinho")]),
        "understat_transfer_team_override": make("understat_transfer_team_override", [(900, "2025-2026", "Eberechi Eze", 57, "Arsenal")]),
        "understat_player_exclusion": make("understat_player_exclusion", [(903, "2025-2026", "Ghost", "wrong lineup")]),
        "search_aliases_seed": make("search_aliases_seed", [("team", " MU ", 66), ("team", "gunners", 57), ("team", "old", 1), ("player", "starboy", 12)]),
    }


def load(spark, folder):
    """(raw root, bronze path, tracking, quarantine, counts) after a first ingest."""
    root, target = f"{folder}/raw", f"{folder}/bronze"
    write_crawl(root)
    tracked, bad, counts = bronze.ingest(spark, root, target, files.empty_tracking(spark))
    return root, target, tracked, bad, counts
