"""Registration and the shared views of the test tables.

The tables hold no football data, so they are viewed as such: every line item is one crawled
snapshot of a match between a supplier team and a part team, customers are the players of the
primary source, orders and line items their season statistics in two further sources. ``SQL_*``
texts state the same views for the SQL side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.constants import SECONDARY, TERTIARY
from touchline.functions.dates import season_of_year
from touchline.functions.numbers import per90
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL of its result (None: not expressible)."""

    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- teams ------------------------------------------------------------------

SQL_TEAMS = """
teams AS (
  SELECT s_suppkey * 2 AS team_id, s_name AS team_name, upper(substr(s_name, 1, 3)) AS team_tla FROM supplier
  UNION ALL
  SELECT p_partkey * 2 + 1, p_name || ' ' || p_partkey, upper(substr(p_name, 1, 3)) FROM part
)"""


def teams(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 2).alias("team_id"), F.col("s_name").alias("team_name"),
        F.upper(F.substring("s_name", 1, 3)).alias("team_tla"),
    )
    p = table(spark, sf, "part").select(
        (F.col("p_partkey") * 2 + 1).alias("team_id"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("team_name"),
        F.upper(F.substring("p_name", 1, 3)).alias("team_tla"),
    )
    return s.unionByName(p).withColumns({
        "team_short_name": F.substring("team_name", 1, 8), "league": F.lit("all"),
    })


# --- matches ----------------------------------------------------------------

SQL_SNAPSHOTS = """
match_snapshots AS (
  SELECT l_orderkey * 10 + l_linenumber AS source_match_id,
         l_returnflag AS league,
         CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) + 1 AS VARCHAR) AS season,
         CAST(l_linenumber AS BIGINT) AS matchday,
         CASE WHEN l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '1999-01-01' THEN 'SCHEDULED'
              WHEN l_tax >= 0.08 THEN 'AWARDED' ELSE 'FINISHED' END AS status,
         l_shipdate AS utc_date,
         l_suppkey * 2 AS home_team_id,
         l_partkey * 2 + 1 AS away_team_id,
         CASE WHEN l_discount < 0.1 THEN CAST(l_quantity AS BIGINT) % 5 END AS home_score,
         CAST(l_linenumber AS BIGINT) % 5 AS away_score,
         l_extendedprice
  FROM lineitem
)"""

SQL_MATCHES = SQL_SNAPSHOTS + """,
matches AS (
  SELECT * EXCLUDE (l_extendedprice, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY source_match_id
        ORDER BY utc_date DESC, away_team_id DESC, home_team_id DESC, l_extendedprice DESC) AS rn
    FROM match_snapshots) WHERE rn = 1
)"""


def match_snapshots(spark, sf) -> DataFrame:
    """Staged match rows before deduplication, ``l_extendedprice`` kept as the last tie-break."""
    year = F.year("l_shipdate")
    late = (F.col("l_linestatus") == "O") & (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_match_id"),
        F.col("l_returnflag").alias("league"),
        season_of_year(year).alias("season"),
        F.col("l_linenumber").cast("bigint").alias("matchday"),
        F.when(late, "SCHEDULED").when(F.col("l_tax") >= 0.08, "AWARDED").otherwise("FINISHED").alias("status"),
        F.col("l_shipdate").alias("utc_date"),
        (F.col("l_suppkey") * 2).alias("home_team_id"),
        (F.col("l_partkey") * 2 + 1).alias("away_team_id"),
        F.when(F.col("l_discount") < 0.1, F.col("l_quantity").cast("bigint") % 5).alias("home_score"),
        (F.col("l_linenumber").cast("bigint") % 5).alias("away_score"),
        "l_extendedprice",
    )


def matches(spark, sf) -> DataFrame:
    """Latest snapshot of each match."""
    order = [F.col(c).desc() for c in ("utc_date", "away_team_id", "home_team_id", "l_extendedprice")]
    return latest_per_key(match_snapshots(spark, sf), ["source_match_id"], order).drop("l_extendedprice")


def match_table(spark, sf) -> DataFrame:
    """The same as a materialised table, for models that read it several times."""
    return cut_lineage(matches(spark, sf))


SQL_SIDES = """
sides AS (
  SELECT league, season, home_team_id AS team_id, source_match_id, utc_date, status,
         home_score AS gf, away_score AS ga FROM matches
  UNION ALL
  SELECT league, season, away_team_id, source_match_id, utc_date, status, away_score, home_score FROM matches
)"""

SQL_BY_MATCHDAY = SQL_MATCHES + "," + SQL_SIDES + """,
by_matchday AS (
  SELECT league, season, team_id, source_match_id, utc_date,
         count(*) OVER w AS played_games,
         CAST(sum(CASE WHEN gf > ga THEN 1 ELSE 0 END) OVER w AS BIGINT) AS won,
         CAST(sum(CASE WHEN gf = ga THEN 1 ELSE 0 END) OVER w AS BIGINT) AS draw,
         CAST(sum(CASE WHEN gf < ga THEN 1 ELSE 0 END) OVER w AS BIGINT) AS lost,
         CAST(sum(CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END) OVER w AS BIGINT) AS points,
         CAST(sum(gf) OVER w AS BIGINT) AS goals_for,
         CAST(sum(ga) OVER w AS BIGINT) AS goals_against,
         CAST(sum(gf) OVER w - sum(ga) OVER w AS BIGINT) AS goal_difference
  FROM sides WHERE status = 'FINISHED'
  WINDOW w AS (PARTITION BY league, season, team_id ORDER BY utc_date, source_match_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

SQL_TEAM_SEASONS = """
team_seasons AS (
  SELECT DISTINCT s.league, s.season, s.team_id, t.team_name, substr(t.team_name, 1, 8) AS team_short_name, t.team_tla
  FROM sides s JOIN teams t USING (team_id)
)"""


def team_seasons(spark, sf, played: DataFrame | None = None) -> DataFrame:
    """Teams with any match in a (league, season), with their names."""
    played = matches(spark, sf) if played is None else played
    ids = played.select("league", "season", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).distinct()
    return ids.join(teams(spark, sf).drop("league"), "team_id").select(
        "league", "season", "team_id", "team_name", "team_short_name", "team_tla"
    )


# --- players ----------------------------------------------------------------
# Primary: customers, crawled twice; a fifth of them share names in groups of ten.
# Secondary: one season row per order, urgent orders under ids the primary source does not know.
# Tertiary: one season row per line item.

SQL_STAGED_PLAYERS = """
p_players AS (
  SELECT c_custkey AS player_id,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Pläyer ' || CAST(c_custkey // 10 AS VARCHAR)
              ELSE 'Player ' || CAST(c_custkey AS VARCHAR) END AS player_name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Goalkeeper' WHEN 'MACHINERY' THEN 'Defence'
              WHEN 'FURNITURE' THEN 'Midfield' WHEN 'HOUSEHOLD' THEN 'Offence' END AS position,
         CASE WHEN c_custkey % 3 > 0 THEN DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) END AS date_of_birth,
         'Nation ' || CAST(c_nationkey AS VARCHAR) AS nationality,
         CASE WHEN c_custkey % 7 > 0 THEN c_custkey % 99 END AS shirt_number,
         CASE WHEN c_acctbal >= 0 THEN (c_nationkey + v.shift) * 2 END AS team_id,
         'A' AS league, v.ts AS ingestion_time
  FROM customer, (VALUES (3, TIMESTAMP '2024-01-01'), (0, TIMESTAMP '2024-02-01')) v(shift, ts)
),
s_stats AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey + 1000000 ELSE o_custkey END AS understat_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Urgent &#039;' ELSE 'PLAYER-' END || CAST(o_custkey AS VARCHAR)
             AS raw_player_name,
         CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR) AS season,
         CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END AS league,
         CASE WHEN o_totalprice < 400000 THEN (o_custkey % 25) * 2 END AS team_id,
         o_orderkey % 39 AS apps, o_orderkey % 3000 AS minutes, o_orderkey % 31 AS goals, o_orderkey % 17 AS assists,
         o_orderkey % 5000 AS xg_cents, o_orderkey % 3000 AS xa_cents,
         CASE o_orderstatus WHEN 'F' THEN 'Goalkeeper' WHEN 'O' THEN 'Midfield' END AS position,
         o_orderdate + to_microseconds(o_orderkey) AS ingestion_time
  FROM orders
),
t_stats AS (
  SELECT 'player.' || CAST(l_partkey AS VARCHAR) AS raw_player_name,
         CAST(year(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) + 1 AS VARCHAR) AS season,
         l_returnflag AS league,
         CASE WHEN l_tax > 0 THEN (l_partkey % 25) * 2 + (CASE WHEN l_linestatus = 'F' THEN 0 ELSE 2 END) END AS team_id,
         CAST(l_quantity AS BIGINT) AS goals,
         l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) AS ingestion_time
  FROM lineitem
),
name_map AS (
  SELECT 'understat' AS source, 'PLAYER-' || CAST(c_custkey AS VARCHAR) AS raw_player_name,
         (c_custkey % 25) * 2 AS team_id, c_custkey AS player_id
  FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT 'statbunker', 'player.' || CAST(c_custkey AS VARCHAR), (c_custkey % 25) * 2, c_custkey
  FROM customer WHERE c_mktsegment = 'BUILDING'
),
extra AS (
  SELECT c_custkey AS player_id, 'Extra' AS x_nat, DATE '1970-05-05' AS x_dob, c_custkey % 50 AS x_shirt
  FROM customer WHERE c_acctbal > 5000
),
display AS (SELECT c_custkey AS player_id, 'Star ' || c_name AS display_name FROM customer WHERE c_acctbal > 9000)"""


def _custkey_text():
    return F.col("c_custkey").cast("string")


def staged_primary(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    shared = F.concat(F.lit("Pläyer "), F.floor(F.col("c_custkey") / 10).cast("string"))
    crawls = F.explode(F.array(
        F.struct(F.lit(3).alias("shift"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts")),
        F.struct(F.lit(0).alias("shift"), F.lit("2024-02-01").cast("timestamp_ntz").alias("ts")),
    ))
    return c.withColumn("v", crawls).select(
        F.col("c_custkey").alias("player_id"),
        F.when(seg == "BUILDING", shared).otherwise(F.concat(F.lit("Player "), _custkey_text())).alias("player_name"),
        F.when(seg == "BUILDING", "Goalkeeper").when(seg == "MACHINERY", "Defence").when(seg == "FURNITURE", "Midfield")
        .when(seg == "HOUSEHOLD", "Offence").alias("position"),
        F.when(F.col("c_custkey") % 3 > 0, F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")))
        .alias("date_of_birth"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("nationality"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_custkey") % 99).alias("shirt_number"),
        F.when(F.col("c_acctbal") >= 0, ((F.col("c_nationkey") + F.col("v.shift")) * 2).cast("bigint")).alias("team_id"),
        F.lit("A").alias("league"),
        F.col("v.ts").alias("ingestion_time"),
    )


def _shift(ts: str, micros):
    """Timestamp plus a number of microseconds."""
    return F.col(ts) + F.make_dt_interval(secs=(micros.cast("decimal(18,6)") / F.lit(1000000)).cast("decimal(18,6)"))


def staged_secondary(spark, sf) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey")

    def hundredths(mod: int):
        return ((key % mod).cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,10)")

    o = table(spark, sf, "orders").select(
        F.when(urgent, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("understat_id"),
        F.concat(F.when(urgent, "Urgent &#039;").otherwise("PLAYER-"), F.col("o_custkey").cast("string")).alias("raw_player_name"),
        season_of_year(F.year("o_orderdate")).alias("season"),
        F.when(status == "F", "A").when(status == "O", "N").otherwise("R").alias("league"),
        F.when(F.col("o_totalprice") < 400000, (F.col("o_custkey") % 25) * 2).alias("team_id"),
        (key % 39).alias("apps"), (key % 3000).alias("minutes"), (key % 31).alias("goals"), (key % 17).alias("assists"),
        hundredths(5000).alias("xg"), hundredths(3000).alias("xa"),
        F.when(status == "F", "Goalkeeper").when(status == "O", "Midfield").alias("position"),
        _shift("o_orderdate", key).alias("ingestion_time"),
    )
    return o.withColumns({"xg90": per90("xg", "minutes"), "xa90": per90("xa", "minutes")})


def staged_tertiary(spark, sf) -> DataFrame:
    moved = F.when(F.col("l_linestatus") == "F", 0).otherwise(2)
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("player."), F.col("l_partkey").cast("string")).alias("raw_player_name"),
        season_of_year(F.year("l_shipdate")).alias("season"),
        F.col("l_returnflag").alias("league"),
        F.when(F.col("l_tax") > 0, (F.col("l_partkey") % 25) * 2 + moved).alias("team_id"),
        F.col("l_quantity").cast("bigint").alias("goals"),
        _shift("l_shipdate", F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingestion_time"),
    )


def name_map(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    rows = F.explode(F.array(
        F.struct(F.lit(SECONDARY).alias("source"), F.concat(F.lit("PLAYER-"), _custkey_text()).alias("raw_player_name")),
        F.struct(F.lit(TERTIARY).alias("source"), F.concat(F.lit("player."), _custkey_text()).alias("raw_player_name")),
    ))
    return c.select(rows.alias("r"), "c_custkey").select(
        "r.source", "r.raw_player_name", ((F.col("c_custkey") % 25) * 2).alias("team_id"), F.col("c_custkey").alias("player_id")
    )


def extra_info(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").filter("c_acctbal > 5000").select(
        F.col("c_custkey").alias("player_id"), F.lit("Extra").alias("nationality"),
        F.lit("1970-05-05").cast("date").alias("date_of_birth"), (F.col("c_custkey") % 50).alias("shirt_number"),
    )


def display_names(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").filter("c_acctbal > 9000").select(
        F.col("c_custkey").alias("player_id"), F.concat(F.lit("Star "), F.col("c_name")).alias("display_name")
    )


