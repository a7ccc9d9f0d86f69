"""Data-quality checks (DQ1-DQ6, DQ11-DQ14) and ingest bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.dates import file_league, file_season_token, normalize_season
from touchline.plans import gold, quality
from touchline.registry.base import query, table
from touchline.sources import files
from touchline.sources.bronze import profile

NOW = "2024-01-31 12:00:00"


@query("dq_unique_grain", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_grain(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    return quality.unique_violations(rows, ["l_orderkey", "l_linenumber"])


@query("dq_unique_ignoring_null", "SELECT k, count(*) AS n FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dq_unique_ignoring_null(spark, sf):
    k = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k")
    return quality.unique_violations(table(spark, sf, "orders").select(k), ["k"], ignore_nulls=True)


@query("dq_not_null", """SELECT 'status' AS column_name, count(*) AS nulls FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'o_custkey', count(*) FROM orders WHERE o_custkey IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'priority', count(*) FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL HAVING count(*) > 0""")
def dq_not_null(spark, sf):
    o = table(spark, sf, "orders").withColumns({
        "status": F.nullif(F.col("o_orderstatus"), F.lit("P")), "priority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
    })
    return quality.null_counts(o, ["status", "o_custkey", "priority"])


@query("dq_accepted_values", "SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3, 4, 5) GROUP BY 1")
def dq_accepted_values(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    return quality.not_accepted(rows, "l_linenumber", [1, 2, 3, 4, 5])


@query("dq_relationships", "SELECT event_id, user_id FROM events WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)")
def dq_relationships(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return quality.orphans(e, "user_id", table(spark, sf, "supplier"), "s_suppkey")


@query("dq_freshness", f"""SELECT user_id, max(ts) AS last_loaded, CASE WHEN max(ts) < TIMESTAMP '{NOW}' - INTERVAL 7 DAY THEN 'error'
    WHEN max(ts) < TIMESTAMP '{NOW}' - INTERVAL 3 DAY THEN 'warn' ELSE 'pass' END AS status FROM events GROUP BY 1""")
def dq_freshness(spark, sf):
    return quality.freshness(table(spark, sf, "events"), "user_id", "ts", F.lit(NOW).cast("timestamp_ntz"))


_SQL_BRONZE = """
docs AS (
  SELECT CASE event_type WHEN 'click' THEN 'football_data_org' WHEN 'view' THEN 'understat' ELSE 'statbunker' END AS source,
         CASE WHEN value > 10 THEN 'matches' ELSE 'standings' END AS entity_type,
         CASE user_id % 4 WHEN 0 THEN 'premier-league' WHEN 1 THEN 'ligue-1' WHEN 2 THEN 'bundesliga' END AS league,
         CASE WHEN event_id % 50 > 0 THEN CAST(2000 + day(ts) AS VARCHAR) || '-' || CAST(2001 + day(ts) AS VARCHAR) END AS season
  FROM events),
census AS (SELECT source, entity_type, league, season, count(*) AS count FROM docs GROUP BY ALL),
expected AS (SELECT * FROM (VALUES
  ('football_data_org', 'matches', 'premier-league'), ('football_data_org', 'matches', 'ligue-1'),
  ('football_data_org', 'standings', 'premier-league'), ('football_data_org', 'standings', 'ligue-1'),
  ('statbunker', 'standings', 'premier-league'), ('understat', 'standings', 'premier-league'),
  ('understat', 'standings', 'ligue-1')) e(source, entity_type, league))"""


def _bronze(spark, sf):
    kind, year = F.col("event_type"), F.lit(2000) + F.day("ts")
    return table(spark, sf, "events").select(
        F.when(kind == "click", "football_data_org").when(kind == "view", "understat").otherwise("statbunker").alias("source"),
        F.when(F.col("value") > 10, "matches").otherwise("standings").alias("entity_type"),
        F.when(F.col("user_id") % 4 == 0, "premier-league").when(F.col("user_id") % 4 == 1, "ligue-1")
        .when(F.col("user_id") % 4 == 2, "bundesliga").alias("league"),
        F.when(F.col("event_id") % 50 > 0, F.concat_ws("-", year.cast("string"), (year + 1).cast("string"))).alias("season"),
    )


@query("dq_census", f"WITH {_SQL_BRONZE} SELECT * FROM census")
def dq_census(spark, sf):
    return quality.census(_bronze(spark, sf))


@query("dq_gaps", f"""WITH {_SQL_BRONZE},
    wanted AS (SELECT DISTINCT e.source, e.entity_type, e.league, c.season FROM expected e JOIN census c ON c.league = e.league WHERE c.season IS NOT NULL)
    SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM census c WHERE (c.source, c.entity_type, c.league, c.season) = (w.source, w.entity_type, w.league, w.season))""")
def dq_gaps(spark, sf):
    return quality.find_gaps(quality.census(_bronze(spark, sf)), quality.expected_combos(spark))


@query("dq_unexpected", f"WITH {_SQL_BRONZE} SELECT source, entity_type, league, season FROM census c WHERE NOT EXISTS (SELECT 1 FROM expected e WHERE e.source = c.source AND e.entity_type = c.entity_type AND e.league = c.league)")
def dq_unexpected(spark, sf):
    return quality.find_unexpected(quality.census(_bronze(spark, sf)), quality.expected_combos(spark))


@query("bronze_profile", f"WITH {_SQL_BRONZE} SELECT source, entity_type, count(*) AS n FROM docs GROUP BY ALL")
def bronze_profile(spark, sf):
    return profile(_bronze(spark, sf))


_SQL_ALIASES = """
aliases AS (
  SELECT CASE WHEN p_size % 2 = 0 THEN 'team' ELSE 'player' END AS entity_type, lower(trim('  ' || p_name || ' ' || p_brand)) AS alias,
         p_partkey * 2 AS entity_id FROM part)"""


def _aliases(spark, sf):
    p = table(spark, sf, "part")
    seed = p.select(
        F.when(F.col("p_size") % 2 == 0, "team").otherwise("player").alias("entity_type"),
        F.concat(F.lit("  "), "p_name", F.lit(" "), "p_brand").alias("alias"), (F.col("p_partkey") * 2).alias("entity_id"),
    )
    return gold.search_aliases(seed)


@query("search_aliases", f"WITH {_SQL_ALIASES} SELECT * FROM aliases")
def search_aliases(spark, sf):
    return _aliases(spark, sf)


@query("dq_alias_resolves", f"""WITH {_SQL_ALIASES}
    SELECT * FROM aliases WHERE (entity_type = 'team' AND entity_id NOT IN (SELECT s_suppkey * 2 FROM supplier))
    OR (entity_type = 'player' AND entity_id NOT IN (SELECT c_custkey FROM customer))""")
def dq_alias_resolves(spark, sf):
    players = table(spark, sf, "customer").select(F.col("c_custkey").alias("player_id"))
    clubs = table(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("team_id"))
    return quality.unresolved_aliases(_aliases(spark, sf), clubs, players)


@query("dq_unmapped_teams", """SELECT 'statbunker' AS source, p_name AS raw_team_name FROM part WHERE p_size <= 25 AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_partkey)
    UNION ALL SELECT 'understat', p_name FROM part WHERE p_size > 25 AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = p_partkey)""")
def dq_unmapped_teams(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.col("s_suppkey").alias("team_id"))
    rows = table(spark, sf, "part").join(s, "p_partkey", "left").withColumnRenamed("p_name", "raw_team_name")
    return quality.unmapped_teams(rows.filter("p_size <= 25"), rows.filter("p_size > 25"))


@query("dq_summary", """SELECT 'lineitem_grain' AS check_name, 'error' AS severity, count(*) AS violations FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'orders_grain', 'error', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'order_customer', 'warn', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def dq_summary(spark, sf):
    o, rich = table(spark, sf, "orders"), table(spark, sf, "customer").filter("c_acctbal > 0")
    return quality.summarize([
        quality.CheckResult("lineitem_grain", quality.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])),
        quality.CheckResult("orders_grain", quality.unique_violations(o, ["o_orderkey"])),
        quality.CheckResult("order_customer", quality.orphans(o, "o_custkey", rich, "c_custkey"), "warn"),
    ])


# --- ingest bookkeeping over a listing made of order rows -----------------------

_SQL_LISTING = """
listing AS (SELECT CAST(o_orderkey AS VARCHAR) AS rel_path, o_orderdate AS mtime, CAST(round(o_totalprice) AS BIGINT) AS size_bytes FROM orders),
tracked AS (SELECT CAST(o_orderkey AS VARCHAR) AS file_path, o_orderdate AS mtime,
                   CAST(round(o_totalprice) AS BIGINT) + (CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS size_bytes
            FROM orders WHERE o_orderpriority <> '5-LOW')"""


def _listing(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("rel_path"), F.col("o_orderdate").alias("mtime"),
        F.round("o_totalprice").cast("bigint").alias("size_bytes"), F.lit("s").alias("source"), F.lit("e").alias("entity_type"),
        "o_orderstatus", "o_orderpriority",
    )


def _tracked(spark, sf):
    rows = _listing(spark, sf).filter("o_orderpriority <> '5-LOW'")
    grown = F.col("size_bytes") + F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)
    return rows.select(
        F.col("rel_path").alias("file_path"), "source", "entity_type", "mtime", grown.alias("size_bytes"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("ingested_at"),
    )


@query("pending_files", f"WITH {_SQL_LISTING} SELECT rel_path, mtime, size_bytes FROM listing l WHERE NOT EXISTS (SELECT 1 FROM tracked t WHERE t.file_path = l.rel_path AND t.mtime = l.mtime AND t.size_bytes = l.size_bytes)")
def pending_files(spark, sf):
    return files.pending_files(_listing(spark, sf), _tracked(spark, sf)).select("rel_path", "mtime", "size_bytes")


@query("tracking_upsert", f"""WITH {_SQL_LISTING},
    pending AS (SELECT * FROM listing l WHERE NOT EXISTS (SELECT 1 FROM tracked t WHERE t.file_path = l.rel_path AND t.mtime = l.mtime AND t.size_bytes = l.size_bytes))
    SELECT coalesce(p.rel_path, t.file_path) AS file_path, coalesce(p.mtime, t.mtime) AS mtime, coalesce(p.size_bytes, t.size_bytes) AS size_bytes,
           CASE WHEN p.rel_path IS NULL THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2024-01-01' END AS ingested_at
    FROM tracked t FULL JOIN pending p ON p.rel_path = t.file_path""")
def tracking_upsert(spark, sf):
    tracked = _tracked(spark, sf)
    done = files.pending_files(_listing(spark, sf), tracked)
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    return files.mark_ingested(tracked, done, now).select("file_path", "mtime", "size_bytes", "ingested_at")


_SQL_NAMES = """
names AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'PL_' WHEN '2-HIGH' THEN 'EPL_' WHEN '3-MEDIUM' THEN 'FL1_'
           WHEN '4-NOT SPECIFIED' THEN 'Ligue_1_' ELSE 'BL1_' END
         || CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) AS VARCHAR)
              WHEN 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR) ELSE 'latest' END
         || '_' || o_custkey || '_120000_000001.json' AS file_name, o_orderpriority AS p, o_orderstatus AS s, year(o_orderdate) AS y
  FROM orders)"""


@query("file_metadata", f"""WITH {_SQL_NAMES}
    SELECT o_orderkey, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'premier-league' WHEN p <> '5-LOW' THEN 'ligue-1' END AS league,
           CASE WHEN p <> '5-LOW' AND s <> 'P' THEN y || '-' || (y + 1) END AS season FROM names""")
def file_metadata(spark, sf):
    p, s, y = F.col("o_orderpriority"), F.col("o_orderstatus"), F.year("o_orderdate")
    code = F.when(p == "1-URGENT", "PL_").when(p == "2-HIGH", "EPL_").when(p == "3-MEDIUM", "FL1_").when(p == "4-NOT SPECIFIED", "Ligue_1_").otherwise("BL1_")
    token = F.when(s == "F", y.cast("string")).when(s == "O", F.concat_ws("-", y.cast("string"), (y + 1).cast("string"))).otherwise("latest")
    named = table(spark, sf, "orders").select("o_orderkey", F.concat(code, token, F.lit("_"), "o_custkey", F.lit("_120000_000001.json")).alias("file_name"))
    return named.select("o_orderkey", file_league("file_name").alias("league"), normalize_season(file_season_token("file_name")).alias("season"))


@query("not_collected_today", """SELECT c_custkey, code, season, club_id FROM (SELECT c_custkey, c_mktsegment AS code, '2024-2025' AS season, c_nationkey AS club_id FROM customer) w
    WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE w.code = CASE WHEN s_acctbal > 0 THEN 'BUILDING' ELSE 'MACHINERY' END AND w.club_id = s_nationkey)""")
def not_collected_today(spark, sf):
    work = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("code"), F.lit("2024-2025").alias("season"), F.col("c_nationkey").alias("club_id"))
    code = F.when(F.col("s_acctbal") > 0, "BUILDING").otherwise("MACHINERY")
    listed = table(spark, sf, "supplier").select(
        F.lit("2024-08-01").alias("date"), F.lit("player_stats").alias("entity_type"),
        F.concat(code, F.lit("_2024-2025_"), F.col("s_nationkey"), F.lit("_101500_000123.json")).alias("file_name"),
    )
    return files.not_collected_today(work, listed, "2024-08-01", "player_stats")
