"""Message and log tables: screening, intent, statement audit, cost (M1, M2, M4-M9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import (
    ADHOC_ROW_LIMIT, ADHOC_TABLES, INJECTION_PHRASES, INTENT_KEYWORDS, REFUSALS, REFUSED_SQL_KEYWORDS, UNKNOWN_INTENT,
)
from touchline.functions.numbers import token_cost
from touchline.operators.mentions import resolve_mentions


def is_injection(c: Column | str) -> Column:
    """M1."""
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike("(?iu)(" + "|".join(INJECTION_PHRASES) + ")")


def intent(c: Column | str) -> Column:
    """M2: label of the first keyword list with a hit."""
    text = F.concat(F.lit(" "), F.lower(c), F.lit(" "))
    labelled = []
    for label, keywords in INTENT_KEYWORDS:
        hit = text.contains(keywords[0])
        for keyword in keywords[1:]:
            hit = hit | text.contains(keyword)
        labelled.append(F.when(hit, F.lit(label)))
    return F.when(F.col(c).isNotNull() if isinstance(c, str) else c.isNotNull(), F.coalesce(*labelled, F.lit(UNKNOWN_INTENT)))


def alias_dictionary(aliases: DataFrame, teams: DataFrame) -> DataFrame:
    """M4: team aliases that still resolve, with the team name."""
    mine = aliases.filter("entity_type = 'team'")
    return mine.join(teams.select("team_id", "team_name"), mine["entity_id"] == teams["team_id"]).select(
        "alias", "team_id", "team_name"
    )


def team_mentions(messages: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """M3 with team names."""
    found = resolve_mentions(messages, key, text, dictionary, "alias", "team_id")
    names = dictionary.select("team_id", "alias", "team_name").distinct()
    return found.join(names, ["team_id", "alias"]).select(key, "mention_rank", "team_id", "team_name", "alias")


def fenced_sql(c: Column | str) -> Column:
    """M5: body of the first code fence labelled sql, trimmed; NULL without a fence."""
    c = F.col(c) if isinstance(c, str) else c
    fence = r"(?is)```sql\s*(.*?)```"
    body = F.regexp_replace(F.regexp_extract(c, fence, 1), r"^\s+|\s+$", "")
    return F.when(c.rlike(fence), body)


def audit_sql(df: DataFrame, statement: str, limit: int = ADHOC_ROW_LIMIT) -> DataFrame:
    """M6: adds ``verdict`` ('ok' or the reason of refusal) and ``safe_sql`` (limit forced) columns."""
    trimmed = F.regexp_replace(F.col(statement), r"^\s+|\s+$", "")
    body = F.regexp_replace(F.regexp_replace(trimmed, ";+$", ""), r"^\s+|\s+$", "")
    df = df.withColumn("_body", body)
    tables = F.array_distinct(F.regexp_extract_all("_body", F.lit(r"(?iU)\b(?:FROM|JOIN)\s+gold\.(\w+)"), F.lit(1)))
    df = df.withColumn("_unknown", F.array_sort(F.array_except(tables, F.array(*map(F.lit, ADHOC_TABLES)))))
    df = df.withColumn("_tables", tables)
    b = F.col("_body")
    refused = r"(?iU)\b(" + "|".join(REFUSED_SQL_KEYWORDS) + r")\b"
    verdict = (
        F.when(b.isNull(), F.lit(None))
        .when(b.contains(";"), F.lit(REFUSALS["several"]))
        .when(~b.rlike(r"(?iU)^(SELECT|WITH)\b"), F.lit(REFUSALS["not_select"]))
        .when(b.rlike(refused), F.lit(REFUSALS["keyword"]))
        .when(F.size("_tables") == 0, F.lit(REFUSALS["no_table"]))
        .when(F.size("_unknown") > 0, F.concat(F.lit(REFUSALS["unknown"]), F.array_join("_unknown", ", ")))
        .otherwise(F.lit("ok"))
    )
    limit_clause = r"(?iU)\bLIMIT\s+(\d+)\b"
    asked = F.regexp_extract(b, limit_clause, 1)
    too_large = F.coalesce(asked.try_cast("decimal(38,0)") > limit, F.length(asked) > 38)
    safe = (
        F.when(~b.rlike(limit_clause), F.concat(b, F.lit(f" LIMIT {limit}")))
        .when(too_large, F.regexp_replace(b, limit_clause, f"LIMIT {limit}"))
        .otherwise(b)
    )
    out = df.withColumn("verdict", verdict)
    return out.withColumn("safe_sql", F.when(F.col("verdict") == "ok", safe)).drop("_body", "_unknown", "_tables")


def flatten_price_catalog(catalog: DataFrame, payload: str = "payload") -> DataFrame:
    """M9: model catalog documents to one row per model with prices per million tokens."""
    schema = "data ARRAY<STRUCT<id:STRING,context_length:INT,pricing:STRUCT<prompt:STRING,completion:STRING>>>"
    rows = catalog.select(F.explode(F.from_json(payload, schema)["data"]).alias("m"))

    def per_million(price: str) -> Column:
        return F.round(F.coalesce(F.col(f"m.pricing.{price}").cast("double"), F.lit(0.0)) * 1000000, 6)

    return rows.select(
        F.col("m.id").alias("model"),
        F.col("m.context_length").alias("context_window"),
        per_million("prompt").alias("prompt_price_per_million"),
        per_million("completion").alias("completion_price_per_million"),
    )


def with_cost(log: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost estimate of each request; NULL for a model without a price row."""
    side = prices.select("model", "prompt_price_per_million", "completion_price_per_million", F.lit(True).alias("_known"))
    cost = token_cost(
        "prompt_tokens", "completion_tokens", "prompt_price_per_million", "completion_price_per_million"
    )
    joined = log.join(side, "model", "left")
    return joined.withColumn("cost_estimate_usd", F.when(F.col("_known"), cost)).drop(
        "_known", "prompt_price_per_million", "completion_price_per_million"
    )


def append_chat_log(log: DataFrame, table_path: str) -> None:
    """M7: append one row per request, refusals and errors included."""
    log.write.mode("append").parquet(table_path)


def model_comparison(log: DataFrame, conversation_prefix: str | None = None) -> DataFrame:
    """Requests, mean latency and mean cost per model."""
    if conversation_prefix:
        log = log.filter(F.col("conversation_id").startswith(conversation_prefix))
    return log.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.round(F.avg("latency_ms")).alias("avg_latency_ms"),
        F.round(F.avg("cost_estimate_usd"), 6).alias("avg_cost_usd"),
    )
