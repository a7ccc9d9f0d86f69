"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(20,10)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_int(c: Column | str, sentinel: str = "-") -> Column:
    """P5: text count with a sentinel for none; sentinel and NULL both become 0."""
    return F.coalesce(F.nullif(_c(c), F.lit(sentinel)), F.lit("0")).cast("int")


def per90(value: Column | str, minutes: Column | str) -> Column:
    """Rate per 90 minutes to 3 digits in decimal arithmetic; NULL at 0 minutes."""
    played = F.nullif(_c(minutes), F.lit(0)).cast("decimal(20,0)")
    return F.round(_c(value).cast(DECIMAL) / played * F.lit(90), 3)


def league_points(won: Column | str, draw: Column | str) -> Column:
    """N2."""
    return _c(won) * 3 + _c(draw)


def token_cost(prompt_tokens, completion_tokens, prompt_price, completion_price) -> Column:
    """Cost from per-million prices to 6 digits; a missing price counts as 0."""
    million = F.lit(1000000.0)
    return F.round(
        _c(prompt_tokens) / million * F.coalesce(_c(prompt_price), F.lit(0.0))
        + _c(completion_tokens) / million * F.coalesce(_c(completion_price), F.lit(0.0)),
        6,
    )


def strip_signed_suffix(c: Column | str) -> Column:
    """Q5: leading part of a number cell before any '+' or '-' suffix."""
    return F.regexp_extract(_c(c), "^([^+-]*)", 1)
