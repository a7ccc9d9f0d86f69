"""Name search and matching joins (X1-X5, K12, K13) over the part and supplier names."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators.matching import similarity_join, substring_join
from touchline.plans import search
from touchline.registry.base import query, table
from touchline.registry.scalars import _SQL_GRAMS

# Queries: every word of the part names, clipped pair names, nation names and brands.
_SQL = f"""
queries AS (
  SELECT DISTINCT unnest(string_split(p_name, ' ')) AS query FROM part
  UNION SELECT DISTINCT ' ' || upper(substr(p_name, 2, length(p_name) - 3)) || ' ' FROM part
  UNION SELECT DISTINCT p_brand FROM part
  UNION SELECT n_name FROM nation),
entities AS (
  SELECT p_partkey AS id, p_name || ' ' || CAST(p_size AS VARCHAR) AS name, p_type AS subtitle FROM part
  UNION ALL SELECT s_suppkey + 100000000, s_name, 'supplier' FROM supplier),
aliases AS (SELECT lower(n_name) AS alias, s_suppkey + 100000000 AS entity_id FROM nation JOIN supplier ON s_nationkey = n_nationkey),
tier1 AS (SELECT q.query, e.id, e.name, e.subtitle, 1 AS priority FROM queries q JOIN aliases a ON a.alias = lower(trim(q.query)) JOIN entities e ON e.id = a.entity_id),
sub AS (SELECT q.query, e.* FROM queries q JOIN entities e ON contains(lower(e.name), lower(trim(q.query)))),
tier2 AS (SELECT query, id, name, subtitle, 2 AS priority FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY name, id) AS rn FROM sub) WHERE rn <= 10),
gq AS (SELECT query, {_SQL_GRAMS.format(c='query')} AS g FROM queries),
gn AS (SELECT name, {_SQL_GRAMS.format(c='name')} AS g FROM (SELECT DISTINCT name FROM entities)),
pairs AS (SELECT query, name, shared / (len(a) + len(b) - shared) AS sim FROM (
  SELECT query, name, gq.g AS a, gn.g AS b, len(list_intersect(gq.g, gn.g)) AS shared FROM gq, gn) WHERE shared > 0),
alike AS (SELECT query, name, CAST(sim AS FLOAT) AS sim FROM pairs WHERE CAST(CAST(sim AS FLOAT) AS DOUBLE) > 0.3),
earlier AS (SELECT query, count(*) AS n FROM (SELECT query FROM tier1 UNION ALL SELECT query FROM tier2) GROUP BY 1),
fuzzy AS (SELECT s.query, e.id, e.name, e.subtitle, s.sim FROM alike s JOIN entities e ON e.name = s.name
          WHERE s.query NOT IN (SELECT query FROM earlier WHERE n >= 10)),
tier3 AS (SELECT query, id, name, subtitle, 3 AS priority FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, name, id) AS rn FROM fuzzy) WHERE rn <= 10),
pooled AS (SELECT * FROM tier1 UNION ALL SELECT * FROM tier2 UNION ALL SELECT * FROM tier3),
best AS (SELECT query, id, min(priority) AS priority, any_value(name) AS name, any_value(subtitle) AS subtitle FROM pooled GROUP BY 1, 2),
merged AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY priority, name, id) AS rank FROM best)"""


def _queries(spark, sf):
    p = table(spark, sf, "part")
    clipped = F.concat(F.lit(" "), F.upper(F.expr("substr(p_name, 2, length(p_name) - 3)")), F.lit(" "))
    parts = [
        p.select(F.explode(F.split("p_name", " ")).alias("query")), p.select(clipped.alias("query")),
        p.select(F.col("p_brand").alias("query")), table(spark, sf, "nation").select(F.col("n_name").alias("query")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).distinct()


def _entities(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"),
        F.col("p_type").alias("subtitle"),
    )
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") + 100000000).alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("subtitle"))
    return p.unionByName(s)


def _aliases(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf, "supplier").join(n, "s_nationkey").select(
        F.lit("team").alias("entity_type"), F.lower("n_name").alias("alias"), (F.col("s_suppkey") + 100000000).alias("entity_id")
    )


def _longs(df):
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("priority", "rank") if c in df.columns})


@query("search_alias", f"WITH {_SQL} SELECT query, id, name, subtitle, CAST(priority AS BIGINT) AS priority FROM tier1")
def search_alias(spark, sf):
    return _longs(search.alias_tier(_queries(spark, sf), _aliases(spark, sf), _entities(spark, sf), "team"))


@query("search_substring", f"WITH {_SQL} SELECT query, id, name, subtitle, CAST(priority AS BIGINT) AS priority FROM tier2")
def search_substring(spark, sf):
    return _longs(search.substring_tier(_queries(spark, sf), _entities(spark, sf)))


@query("search_fuzzy", f"WITH {_SQL}, all_fuzzy AS (SELECT s.query, e.*, s.sim FROM alike s JOIN entities e ON e.name = s.name) SELECT query, id, name, subtitle, CAST(3 AS BIGINT) AS priority FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, name, id) AS rn FROM all_fuzzy) WHERE rn <= 10")
def search_fuzzy(spark, sf):
    return _longs(search.fuzzy_tier(_queries(spark, sf), _entities(spark, sf)))


@query("search_merged", f"WITH {_SQL} SELECT query, 'team' AS type, id, name, subtitle, CAST(priority AS BIGINT) AS priority, rank FROM merged WHERE rank <= 10")
def search_merged(spark, sf):
    found = search.search_entities(_queries(spark, sf), _aliases(spark, sf), _entities(spark, sf), "team")
    return _longs(search.format_results({"team": found}))


# Both entity types in one search: suppliers are the teams, parts the players; aliases name either.
_SQL_BOTH = _SQL.split("entities AS (")[0] + f"""
entities AS (
  SELECT 'player' AS type, p_partkey AS id, p_name || ' ' || CAST(p_size AS VARCHAR) AS name, p_type AS subtitle FROM part
  UNION ALL SELECT 'team', s_suppkey, s_name, 'supplier' FROM supplier),
aliases AS (SELECT 'team' AS type, lower(n_name) AS alias, s_suppkey AS entity_id FROM nation JOIN supplier ON s_nationkey = n_nationkey
  UNION ALL SELECT 'player', lower(p_brand), p_partkey FROM part WHERE p_size = 1),
tier1 AS (SELECT q.query, e.*, 1 AS priority FROM queries q JOIN aliases a ON a.alias = lower(trim(q.query)) JOIN entities e ON e.id = a.entity_id AND e.type = a.type),
sub AS (SELECT q.query, e.* FROM queries q JOIN entities e ON contains(lower(e.name), lower(trim(q.query)))),
tier2 AS (SELECT query, type, id, name, subtitle, 2 AS priority FROM sub QUALIFY row_number() OVER (PARTITION BY type, query ORDER BY name, id) <= 10),
gq AS (SELECT query, {_SQL_GRAMS.format(c='query')} AS g FROM queries),
gn AS (SELECT name, {_SQL_GRAMS.format(c='name')} AS g FROM (SELECT DISTINCT name FROM entities)),
alike AS (SELECT query, name, CAST(shared / (a + b - shared) AS FLOAT) AS sim
  FROM (SELECT query, name, len(gq.g) AS a, len(gn.g) AS b, len(list_intersect(gq.g, gn.g)) AS shared FROM gq, gn)
  WHERE shared > 0 AND CAST(CAST(shared / (a + b - shared) AS FLOAT) AS DOUBLE) > 0.3),
full_up AS (SELECT type, query FROM (SELECT type, query FROM tier1 UNION ALL SELECT type, query FROM tier2) GROUP BY ALL HAVING count(*) >= 10),
fuzzy AS (SELECT s.query, e.*, s.sim FROM alike s JOIN entities e ON e.name = s.name ANTI JOIN full_up f ON f.type = e.type AND f.query = s.query),
tier3 AS (SELECT query, type, id, name, subtitle, 3 AS priority FROM fuzzy QUALIFY row_number() OVER (PARTITION BY type, query ORDER BY sim DESC, name, id) <= 10),
best AS (SELECT query, type, id, min(priority) AS priority, any_value(name) AS name, any_value(subtitle) AS subtitle
  FROM (FROM tier1 UNION ALL FROM tier2 UNION ALL FROM tier3) GROUP BY 1, 2, 3)"""


@query("search_both_types", f"""WITH {_SQL_BOTH} SELECT query, type, id, name, subtitle, CAST(priority AS BIGINT) AS priority,
    row_number() OVER (PARTITION BY type, query ORDER BY priority, name, id) AS rank FROM best QUALIFY rank <= 10""")
def search_both_types(spark, sf):
    """Teams and players found by each query, in one table."""
    part = table(spark, sf, "part")
    players = part.select(
        F.col("p_partkey").alias("player_id"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("player_name"),
        F.col("p_type").alias("team_name"))
    clubs = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("team_name"), F.lit("supplier").alias("league"))
    of_teams = _aliases(spark, sf).withColumn("entity_id", F.col("entity_id") - 100000000)
    of_players = part.filter("p_size = 1").select(F.lit("player").alias("entity_type"), F.lower("p_brand").alias("alias"), F.col("p_partkey").alias("entity_id"))
    return _longs(search.search(_queries(spark, sf), of_teams.unionByName(of_players), clubs, players))


@query("theta_like_join", f"WITH {_SQL} SELECT DISTINCT lower(trim(query)) AS query, name FROM sub")
def theta_like_join(spark, sf):
    asked = _queries(spark, sf).select(F.lower(F.trim("query")).alias("query"))
    return substring_join(asked, "query", _entities(spark, sf), "name")


@query("similarity_join", f"WITH {_SQL} SELECT query, name, round(CAST(sim AS DOUBLE), 6) AS similarity FROM alike")
def trigram_join(spark, sf):
    pairs = similarity_join(_queries(spark, sf), "query", _entities(spark, sf), "name", 0.3)
    return pairs.withColumn("similarity", F.round(F.col("similarity").cast("double"), 6))
