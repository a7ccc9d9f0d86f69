"""Date, season and file-name column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import LEAGUE_CODES


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_years(born: Column | str, today: Column | None = None) -> Column:
    """Completed years between birth date and ``today`` (default: current date)."""
    return F.timestamp_diff("YEAR", _c(born), today if today is not None else F.current_date()).cast("int")


def wall_clock(c: Column | str) -> Column:
    """Timestamp text to a zone-less timestamp; an offset is ignored."""
    return _c(c).cast("timestamp_ntz")


def season_of_year(year: Column) -> Column:
    """``2025`` to ``2025-2026``."""
    return F.concat_ws("-", year.cast("string"), (year + 1).cast("string"))


def normalize_season(token: Column | str) -> Column:
    """D3: a season token; a single year is widened, a range kept, anything else NULL."""
    token = _c(token)
    year = token.try_cast("int")
    return F.when(token.contains("-"), token).when(year.isNotNull(), season_of_year(year))


def season_start(season: Column | str) -> Column:
    """D3: first part of a season."""
    return F.split_part(_c(season), F.lit("-"), F.lit(1))


def file_league_code(filename: Column | str) -> Column:
    """The longest known league code that prefixes a file name, else NULL."""
    filename = _c(filename)
    longest_first = sorted(LEAGUE_CODES, key=len, reverse=True)
    return F.coalesce(*[F.when(filename.startswith(code + "_"), F.lit(code)) for code in longest_first])


def file_league(filename: Column | str) -> Column:
    """League slug of a file name."""
    code = file_league_code(filename)
    return F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in LEAGUE_CODES.items()])


def file_season_token(filename: Column | str) -> Column:
    """Raw season token following the league code, NULL when the code is unknown."""
    filename = _c(filename)
    stem = F.replace(filename, F.lit(".json"), F.lit(""))
    code = file_league_code(filename)
    rest = F.substring(stem, F.length(code) + F.lit(2), F.length(stem))
    return F.when(code.isNotNull(), F.split_part(rest, F.lit("_"), F.lit(1)))
