"""Type-2 history (H1-H3, G8): monthly order states of each customer as successive snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators.ranking import latest_per_key
from touchline.plans import gold, history
from touchline.registry.base import query, table

_SQL = """
snaps AS (
  SELECT o_custkey, date_trunc('month', o_orderdate)::TIMESTAMP AS run_ts, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
  FROM orders GROUP BY 1, 2),
starts AS (
  SELECT * FROM (SELECT *, lag(status) OVER w AS prev, row_number() OVER w AS nth FROM snaps
                 WINDOW w AS (PARTITION BY o_custkey ORDER BY run_ts))
  WHERE nth = 1 OR status IS DISTINCT FROM prev),
history AS (
  SELECT o_custkey, status, run_ts AS valid_from, lead(run_ts) OVER (PARTITION BY o_custkey ORDER BY run_ts) AS valid_to
  FROM starts)"""


def _snapshots(spark, sf):
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    rows = table(spark, sf, "orders").withColumn("run_ts", month)
    newest = latest_per_key(rows, ["o_custkey", "run_ts"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return newest.select("o_custkey", "run_ts", F.col("o_orderstatus").alias("status"))


def _history(spark, sf):
    return history.scd2_replay(_snapshots(spark, sf), ["o_custkey"], ["status"], "run_ts")


@query("scd2_history", f"WITH {_SQL} SELECT * FROM history")
def scd2_history(spark, sf):
    return _history(spark, sf)


@query("scd2_as_of", f"WITH {_SQL} SELECT * FROM history WHERE valid_from <= DATE '1998-07-01' AND (valid_to IS NULL OR valid_to > DATE '1998-07-01')")
def scd2_as_of(spark, sf):
    return history.as_of_history(_history(spark, sf), F.lit("1998-07-01").cast("date"))


@query("scd2_one_open_row", f"""WITH {_SQL}, damaged AS (
      SELECT o_custkey, valid_to FROM history UNION ALL SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE valid_from END FROM history WHERE o_custkey % 7 = 0)
    SELECT o_custkey, count(*) AS n FROM damaged WHERE valid_to IS NULL GROUP BY 1 HAVING count(*) > 1""")
def scd2_one_open_row(spark, sf):
    """A history in which a second run left further versions of some customers, open and closed ones."""
    sound = _history(spark, sf)
    end = F.when(F.col("o_custkey") % 3 == 0, None).otherwise(F.col("valid_from"))
    return history.open_row_violations(sound.unionByName(sound.filter("o_custkey % 7 = 0").withColumn("valid_to", end)), ["o_custkey"])


@query("scd2_next_run", f"""WITH {_SQL},
    current AS (SELECT c_custkey AS o_custkey, CASE WHEN c_acctbal > 5000 THEN 'F' WHEN c_acctbal > 0 THEN 'O' END AS status
                FROM customer WHERE c_mktsegment <> 'BUILDING'),
    pairs AS (SELECT h.*, c.o_custkey AS ck, c.status AS cs, c.o_custkey IS NOT NULL AND h.status IS DISTINCT FROM c.status AS changed
              FROM history h LEFT JOIN current c ON c.o_custkey = h.o_custkey WHERE h.valid_to IS NULL)
    SELECT * FROM history WHERE valid_to IS NOT NULL
    UNION ALL SELECT o_custkey, status, valid_from, CASE WHEN changed THEN TIMESTAMP '2002-01-01' END FROM pairs
    UNION ALL SELECT o_custkey, cs, TIMESTAMP '2002-01-01', NULL FROM pairs WHERE changed
    UNION ALL SELECT o_custkey, status, TIMESTAMP '2002-01-01', NULL FROM current c
              WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.o_custkey = c.o_custkey AND h.valid_to IS NULL)""")
def scd2_next_run(spark, sf):
    bal = F.col("c_acctbal")
    current = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"), F.when(bal > 5000, "F").when(bal > 0, "O").alias("status")
    )
    run_ts = F.lit("2002-01-01").cast("timestamp_ntz")
    return history.scd2_snapshot(_history(spark, sf), current, ["o_custkey"], ["status"], run_ts)


_SQL_STANDINGS = """
rows AS (
  SELECT l_returnflag AS league, CAST(year(l_shipdate) AS VARCHAR) AS season, l_suppkey * 2 AS team_id,
         date_trunc('month', l_shipdate)::TIMESTAMP AS run_ts, count(*) AS played_games,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS points
  FROM lineitem GROUP BY 1, 2, 3, 4),
versions AS (
  SELECT *, run_ts AS valid_from, lead(run_ts) OVER (PARTITION BY league, season, team_id ORDER BY run_ts) AS valid_to
  FROM (SELECT *, lag((played_games, points)) OVER (PARTITION BY league, season, team_id ORDER BY run_ts) AS prev FROM rows)
  WHERE prev IS NULL OR prev IS DISTINCT FROM (played_games, points))"""


@query("standings_history", f"WITH {_SQL_STANDINGS} SELECT league, season, team_id, s_name AS team_name, played_games, points, valid_from, valid_to FROM versions JOIN supplier ON s_suppkey * 2 = team_id")
def standings_history(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({
        "league": F.col("l_returnflag"), "season": F.year("l_shipdate").cast("string"), "team_id": F.col("l_suppkey") * 2,
        "run_ts": F.date_trunc("month", "l_shipdate").cast("timestamp_ntz"),
    })
    snaps = li.groupBy("league", "season", "team_id", "run_ts").agg(
        F.count(F.lit(1)).alias("played_games"), F.sum(F.col("l_quantity").cast("bigint")).alias("points")
    )
    missing = [c for c in history.STANDING_COLUMNS if c not in ("played_games", "points")]
    snaps = snaps.withColumns({c: F.lit(None).cast("bigint") for c in missing})
    versions = history.scd2_replay(snaps, history.STANDING_KEYS, history.STANDING_COLUMNS, "run_ts")
    names = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 2).alias("team_id"), F.col("s_name").alias("team_name"),
        F.lit(None).cast("string").alias("team_short_name"), F.lit(None).cast("string").alias("team_tla"),
    )
    return gold.standings_history(versions, names).select(
        "league", "season", "team_id", "team_name", "played_games", "points", "valid_from", "valid_to"
    )
