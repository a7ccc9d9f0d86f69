"""Runnable queries over the shared test tables, each with an independent SQL statement of its result."""

from __future__ import annotations

from touchline.registry import base
from touchline.registry import (  # noqa: F401  (importing registers the queries)
    documents, history, identity, matches, quality, relational, scalars, search, storage, textlog,
)

QUERIES = base.QUERIES
ORACLES = base.ORACLES
