"""JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(doc: Column | str, path: str, type_: str) -> Column:
    """Q1: typed value at a JSON path of a text document."""
    return F.variant_get(F.parse_json(_c(doc)), path, type_)


def canonical_hash(doc: Column | str) -> Column:
    """SHA-256 of the document with object keys sorted; NULL for invalid JSON."""
    return F.sha2(F.to_json(F.try_parse_json(_c(doc))), 256)


def url_parameter(url: Column | str, name: str) -> Column:
    """Q4: first value of a query parameter."""
    return F.try_parse_url(_c(url), F.lit("QUERY"), F.lit(name))


def rows_as_json(df):
    """Every row rendered as one JSON object."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row_json"))
