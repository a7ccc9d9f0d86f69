"""Dictionary mentions in free text (M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import with_one_row
from touchline.operators.ranking import latest_per_key

_SPAN = "struct<width:int,start:int,stop:int,alias:string,entity:bigint>"


def _pieces(c: Column) -> Column:
    """A text cut at every word boundary; joined again the pieces give the text."""
    return F.filter(F.split(c, r"(?U)\b"), lambda p: p != "")


def phrase_trie(aliases: DataFrame, alias: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """The dictionary as two levels of a trie: per ``first`` piece the phrase lengths (in pieces) below it, and the phrases."""
    pieces = _pieces(F.lower(alias))
    listed = aliases.select(
        F.col(alias).alias("alias"), F.col(entity).cast("bigint").alias("entity"), F.lower(alias).alias("phrase"), pieces.alias("_p")
    ).filter(F.size("_p") > 0)
    phrases = listed.select("alias", "entity", "phrase", F.get("_p", F.lit(0)).alias("first"), F.size("_p").alias("len"))
    branches = phrases.groupBy("first").agg(F.sort_array(F.collect_set("len")).alias("lens"))
    return branches, phrases


def find_spans(texts: DataFrame, key: str, text: str, aliases: DataFrame, alias: str, entity: str) -> DataFrame:
    """Whole-word occurrences of every alias, positions counted in pieces.

    Every position of a text meets the dictionary's first level by its piece; only where some phrase begins with that piece are
    runs formed, one for each phrase length below it, and matched with the phrases. So rows grow with places where a phrase may
    begin, not with positions times lengths. A position carries the pieces that the longest phrase can take.
    """
    branches, phrases = phrase_trie(aliases, alias, entity)
    longest = phrases.agg(F.coalesce(F.max("len"), F.lit(0)).alias("most"))
    cut = texts.select(F.col(key).alias("key"), _pieces(F.lower(text)).alias("p"))
    ahead = F.transform("p", lambda x, i: F.struct(i.alias("start"), x.alias("first"), F.slice("p", i + 1, F.greatest("most", F.lit(1))).alias("ahead")))
    places = with_one_row(cut, longest).select("key", F.size("p").alias("total"), F.explode(ahead).alias("at")).select("key", "total", "at.*")
    begun = places.join(branches, "first").select("key", "total", "start", "first", "ahead", F.explode("lens").alias("len")).filter(F.size("ahead") >= F.col("len"))
    runs = begun.select("key", "total", "start", "first", "len", F.array_join(F.slice("ahead", F.lit(1), F.col("len")), "").alias("phrase"))
    stop = F.col("start") + F.col("len")
    word_edges = (
        ((F.col("start") > 0) | F.col("phrase").rlike(r"(?U)^\w")) & ((stop < F.col("total")) | F.col("phrase").rlike(r"(?U)\w$"))
    )
    return runs.join(phrases, ["first", "phrase", "len"]).filter(word_edges).select(
        "key", F.length("phrase").alias("width"), "start", stop.alias("stop"), "alias", "entity"
    )


def _keep_longest(spans: Column) -> Column:
    """Fold over spans, longest first: a span overlapping an accepted one is dropped."""
    return F.aggregate(
        spans,
        F.array().cast(f"array<{_SPAN}>"),
        lambda acc, s: F.when(
            F.exists(acc, lambda a: (s["start"] < a["stop"]) & (s["stop"] > a["start"])), acc
        ).otherwise(F.array_append(acc, s)),
    )


def resolve_mentions(
    texts: DataFrame, key: str, text: str, aliases: DataFrame, alias: str = "alias", entity: str = "entity_id"
) -> DataFrame:
    """M3: entities mentioned in each text, in order of appearance.

    Longer aliases win over shorter ones they overlap (over the whole text), then each entity
    keeps its first mention. Spans of equal length are taken in order of position, then alias.
    Overlaps are settled per cluster of touching spans, not per text.
    """
    spans = find_spans(texts, key, text, aliases, alias, entity)
    so_far = Window.partitionBy("key").orderBy("start", "stop", "alias", "entity")
    before = F.max("stop").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (before <= F.col("start")), 1).otherwise(0)
    clustered = spans.withColumn("_opens", opens).withColumn(
        "_cluster", F.sum("_opens").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    )
    span = F.struct(
        F.col("width"), F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"), "alias", "entity"
    )
    by_length = F.array_sort(F.collect_list(F.struct((-F.col("width")).alias("w"), "start", "alias", "entity", span.alias("span"))))
    kept = clustered.groupBy("key", "_cluster").agg(
        _keep_longest(F.transform(by_length, lambda s: s["span"])).alias("kept")
    )
    mentions = kept.select("key", F.explode("kept").alias("s")).select("key", "s.start", "s.alias", "s.entity")
    first = latest_per_key(mentions, ["key", "entity"], [F.col("start").asc()])
    rank = F.row_number().over(Window.partitionBy("key").orderBy("start"))
    return first.select(
        F.col("key").alias(key), rank.cast("bigint").alias("mention_rank"), F.col("entity").alias(entity), "alias"
    )
