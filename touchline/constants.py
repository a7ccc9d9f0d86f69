"""Identifiers, codes, word lists and patterns that results depend on."""

from __future__ import annotations

# --- fixed values: source labels ------------------------------------------
PRIMARY = "football_data_org"
SECONDARY = "understat"
TERTIARY = "statbunker"
FALLBACK = "fdo_fallback"

# --- fixed values: identity ------------------------------------------------
SECONDARY_ID_OFFSET = 100000000

# --- fixed values: file-name league codes ---------------------------------
LEAGUE_CODES = {
    "PL": "premier-league",
    "EPL": "premier-league",
    "FL1": "ligue-1",
    "Ligue_1": "ligue-1",
}

# --- fixed values: (source, entity_type, league) that must be collected ----
EXPECTED_COMBOS = [
    ("football_data_org", "matches", "premier-league"),
    ("football_data_org", "matches", "ligue-1"),
    ("football_data_org", "standings", "premier-league"),
    ("football_data_org", "standings", "ligue-1"),
    ("statbunker", "standings", "premier-league"),
    ("understat", "standings", "premier-league"),
    ("understat", "standings", "ligue-1"),
]

# --- fixed values: match status -------------------------------------------
FINISHED = "FINISHED"
CLOSED_STATUSES = ("FINISHED", "AWARDED")

# --- fixed values: position codes and squad order --------------------------
POSITION_PREFIXES = {"GK": "Goalkeeper", "D": "Defence", "M": "Midfield", "F": "Offence"}
POSITION_ORDER = ["Goalkeeper", "Defence", "Midfield", "Offence"]
NO_POSITION_GROUP = "No Position Data"
FORM_LETTERS = ["W", "D", "L"]

# --- fixed values: read limits ---------------------------------------------
DEFAULT_TOP = 10
MAX_TOP = 50
ADHOC_ROW_LIMIT = 100
SEARCH_LIMIT = 10
MIN_SEARCH_LENGTH = 2
FUZZY_THRESHOLD = 0.3
THROTTLE_WINDOW_SECONDS = 60
THROTTLE_LIMIT = 10
FRESHNESS_WARN_DAYS = 3
FRESHNESS_ERROR_DAYS = 7

# --- fixed values: tables open to ad-hoc SQL --------------------------------
ADHOC_TABLES = [
    "league_standings",
    "team_form_last_5_matches",
    "player_profile",
    "player_performance",
    "team_profile",
    "match_results",
    "team_standings_by_matchday",
    "standings_history",
    "search_aliases",
]

# --- fixed values: SQL keywords refused in ad-hoc statements ----------------
REFUSED_SQL_KEYWORDS = [
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "TRUNCATE", "GRANT", "REVOKE",
    "CREATE", "EXECUTE", "CALL", "COPY", "VACUUM", "COMMENT",
]

# --- fixed values: phrases that mark a message as prompt injection ----------
INJECTION_PHRASES = [
    "ignore (all|previous|the above) instructions",
    "disregard (all|previous) instructions",
    "reveal your (prompt|instructions)",
    "show me your (system )?prompt",
    "you are now (a|an)",
    "act as (a|an) (?!football)",
]

# --- fixed values: intent labels and keywords, checked in this order --------
INTENT_KEYWORDS = [
    ("TEAM_STANDINGS_BY_MATCHDAY", [
        "qua các vòng đấu", "theo từng vòng", "by matchday", "matchday by matchday",
    ]),
    ("TEAM_FORM", [
        "phong độ", "form của", "5 trận gần đây", "last 5 matches", "recent form",
    ]),
    ("STANDINGS", [
        "bảng xếp hạng", "xếp hạng", "đứng thứ", "standings", "league table",
        "top of the league", "vị trí trên bảng",
    ]),
    ("MATCH_RESULTS", [
        "tỷ số", "kết quả trận", "kết quả", "match result", "trận đấu", "gặp nhau", " vs ",
    ]),
    ("PLAYER_PERFORMANCE", [
        "ghi bàn", "nhiêu bàn", "kiến tạo", "bàn thắng", "goals scored", "assists", " xg ", " xa ",
    ]),
    ("PLAYER_PROFILE", [
        "quốc tịch", "sinh ngày", "tuổi của", "vị trí thi đấu", "nationality",
        "date of birth", "born on",
    ]),
    ("TEAM_PROFILE", [
        "giải nào", "sân nhà", "viết tắt", "club info", "team profile",
    ]),
]
UNKNOWN_INTENT = "UNKNOWN"

#: What a refused statement is told.
REFUSALS = {
    "several": "multiple statements are not allowed",
    "not_select": "only SELECT/WITH statements are allowed",
    "keyword": "statement contains a disallowed keyword",
    "no_table": "no gold.* table referenced",
    "unknown": "unknown table(s): ",
}
