"""Tiered name search for a table of queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.constants import FUZZY_THRESHOLD, MIN_SEARCH_LENGTH, SEARCH_LIMIT
from touchline.operators.matching import similarity_join, substring_join
from touchline.operators.ranking import latest_per_key, topk_per_key

HIT = ["query", "id", "name", "subtitle", "priority"]


def as_entities(df: DataFrame, id_col: str, name_col: str, subtitle_col: str) -> DataFrame:
    """The columns a search needs."""
    return df.select(
        F.col(id_col).alias("id"), F.col(name_col).alias("name"), F.col(subtitle_col).alias("subtitle")
    )


def _hits(df: DataFrame, priority: int) -> DataFrame:
    return df.withColumn("priority", F.lit(priority)).select(*HIT)


def _asked(queries: DataFrame) -> DataFrame:
    """Distinct queries with their text without outer white space, in lower case; texts under two characters find nothing."""
    text = F.lower(F.regexp_replace("query", r"^\s+|\s+$", ""))
    return queries.select("query").distinct().withColumn("_text", text).filter(F.length("_text") >= MIN_SEARCH_LENGTH)


def alias_tier(queries: DataFrame, aliases: DataFrame, entities: DataFrame, entity_type: str) -> DataFrame:
    """The trimmed lower-cased query equals an alias."""
    mine = aliases.filter(F.col("entity_type") == entity_type).select(
        F.col("alias").alias("_alias"), F.col("entity_id").alias("id")
    )
    asked = _asked(queries).withColumnRenamed("_text", "_alias")
    return _hits(asked.join(mine, "_alias").join(entities, "id"), 1)


def _head_per_name(entities: DataFrame) -> DataFrame:
    """Copies of one name are level in every tier, so only the first of them can reach the result."""
    return topk_per_key(entities, ["name"], [F.col("id").asc()], SEARCH_LIMIT).drop("rank")


def substring_tier(queries: DataFrame, entities: DataFrame) -> DataFrame:
    """Names containing the query (accents and case folded), first by name."""
    asked = _asked(queries)
    # the first names of a query decide before copies of a name are joined back
    head = substring_join(asked, "_text", entities, "name", first=SEARCH_LIMIT)
    found = asked.join(head, "_text").join(_head_per_name(entities), "name")
    best = topk_per_key(found, ["query"], [F.col("name").asc(), F.col("id").asc()], SEARCH_LIMIT)
    return _hits(best, 2)


def fuzzy_tier(queries: DataFrame, entities: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Most similar names above the threshold, for queries the earlier tiers left short."""
    asked = _asked(queries).select("query")
    if earlier is not None:
        full = earlier.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEARCH_LIMIT)
        asked = asked.join(full, "query", "left_anti")
    texts = similarity_join(asked, "query", entities, "name", FUZZY_THRESHOLD)
    order = [F.col("similarity").desc(), F.col("name").asc()]
    head = topk_per_key(texts, ["query"], order, SEARCH_LIMIT).drop("rank")
    found = head.join(_head_per_name(entities), "name")
    return _hits(topk_per_key(found, ["query"], [*order, F.col("id").asc()], SEARCH_LIMIT), 3)


def merge_tiers(tiers: list[DataFrame], limit: int = SEARCH_LIMIT) -> DataFrame:
    """Each entity once at its best priority, ordered by priority then name."""
    pooled = reduce(DataFrame.unionByName, tiers)
    best = latest_per_key(pooled, ["query", "id"], [F.col("priority").asc(), F.col("name").asc()])
    order = [F.col("priority").asc(), F.col("name").asc(), F.col("id").asc()]
    return topk_per_key(best, ["query"], order, limit)


def search_entities(queries: DataFrame, aliases: DataFrame, entities: DataFrame, entity_type: str) -> DataFrame:
    """X1-X4 for one entity type."""
    first = alias_tier(queries, aliases, entities, entity_type)
    second = substring_tier(queries, entities)
    third = fuzzy_tier(queries, entities, first.unionByName(second))
    return merge_tiers([first, second, third])


def format_results(results: dict[str, DataFrame]) -> DataFrame:
    """The results of all entity types as one table of {type, id, name, subtitle}."""
    parts = [
        df.select("query", F.lit(kind).alias("type"), "id", "name", "subtitle", "priority", "rank")
        for kind, df in results.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def search(queries: DataFrame, aliases: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """The whole search: teams with their league, players with their team."""
    return format_results({
        "team": search_entities(queries, aliases, as_entities(teams, "team_id", "team_name", "league"), "team"),
        "player": search_entities(queries, aliases, as_entities(players, "player_id", "player_name", "team_name"), "player"),
    })
