"""Files, reference data, tables, versions and streams in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from touchline.operators.lineage import ensure_checkpoint_dir
from touchline.plans.textlog import append_chat_log
from touchline.registry.base import query, table
from touchline.schemas import CHAT_LOG
from touchline.sources.bronze import read_bronze
from touchline.sources.files import discover_files, save_documents, save_raw
from touchline.sources.seeds import read_seed
from touchline.sources.tables import VersionedTable, materialize, snapshot_summary, verify_counts
from touchline.streaming.history import history_table, start_history
from touchline.streaming.ingest import start_ingest


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"


def _two_versions(spark, sf) -> VersionedTable:
    """Orders replaced twice: first the finished ones, then all."""
    orders, store = table(spark, sf, "orders"), VersionedTable(spark, _folder(spark))
    store.commit(orders.filter("o_orderstatus = 'F'"))
    store.commit(orders)
    return store


@query("table_versions", """SELECT 1::BIGINT AS version, 'replace' AS operation, count(*)::VARCHAR AS added_records, count(*)::VARCHAR AS total_records FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 2, 'replace', count(*)::VARCHAR, count(*)::VARCHAR FROM orders""")
def table_versions(spark, sf):
    return snapshot_summary(_two_versions(spark, sf).snapshots()).drop("committed_at")


@query("time_travel", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def time_travel(spark, sf):
    store = _two_versions(spark, sf)
    return store.read(store.first_version()).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("table_files", "SELECT count(*) AS rows_in_files FROM orders")
def table_files(spark, sf):
    return _two_versions(spark, sf).files().agg(F.sum("record_count").alias("rows_in_files"))


@query("copy_check", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def copy_check(spark, sf):
    orders, store = table(spark, sf, "orders"), VersionedTable(spark, _folder(spark))
    store.commit(orders)
    verify_counts(orders, store.read())
    return store.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_STATUS = "arg_max(o_orderstatus, (o_orderdate, o_orderkey))"
_WAVES = ["1995-01-01", "1998-01-01"]


@query("stream_history", f"""WITH waves AS (
      SELECT o_custkey, 1 + CAST(o_orderdate >= DATE '{_WAVES[0]}' AS INT) + CAST(o_orderdate >= DATE '{_WAVES[1]}' AS INT) AS wave, o_orderstatus, o_orderdate, o_orderkey FROM orders),
    states AS (SELECT o_custkey, wave, {_STATUS} AS status FROM waves GROUP BY 1, 2),
    starts AS (SELECT * FROM (SELECT *, lag(status) OVER w AS prev, row_number() OVER w AS nth FROM states WINDOW w AS (PARTITION BY o_custkey ORDER BY wave))
               WHERE nth = 1 OR status IS DISTINCT FROM prev)
    SELECT o_custkey, status, TIMESTAMP '2024-01-01' + to_days(CAST(wave AS INTEGER)) AS valid_from,
           TIMESTAMP '2024-01-01' + to_days(CAST(lead(wave) OVER (PARTITION BY o_custkey ORDER BY wave) AS INTEGER)) AS valid_to FROM starts""")
def stream_history(spark, sf):
    """Three waves of orders streamed into one history, the last from a second checkpoint; changed customers close versions."""
    base, source = _folder(spark), table(spark, sf, "orders")
    wave = F.lit(1) + (F.col("o_orderdate") >= _WAVES[0]).cast("int") + (F.col("o_orderdate") >= _WAVES[1]).cast("int")
    loaded = F.struct("o_orderdate", "o_orderkey").alias("loaded")
    rows = source.select("o_custkey", F.col("o_orderstatus").alias("status"), loaded, wave.alias("wave"))
    store = history_table(spark, f"{base}/history", rows, ["o_custkey"], ["status"])

    def day(batch):
        return F.timestamp_seconds(F.lit(1704067200 + 86400 * batch.first()["wave"]))

    for k, state in ((1, "a"), (2, "a"), (3, "b")):
        rows.filter(F.col("wave") == k).write.mode("append").parquet(f"{base}/in-{state}")
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{base}/in-{state}")
        start_history(arrivals, store, ["o_custkey"], ["status"], "loaded", f"{base}/state-{state}", day).awaitTermination()
    return store.read().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


# One document per nation and market segment, placed as a crawler would place it.
_SQL_DOCS = """
groups AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1, 2),
docs AS (
  SELECT *, CASE WHEN nation % 2 = 0 THEN 'football_data_org' ELSE 'understat' END AS source, 'matches' AS entity_type,
         '2025-09-0' || (1 + nation % 3) AS date, CASE WHEN nation % 2 = 0 THEN 'PL' ELSE 'EPL' END || '_2025_' || nation || '_' || segment || '_120000_000001.json' AS file_name
  FROM groups)"""


def _documents(spark, sf):
    groups = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    even, nation = F.col("nation") % 2 == 0, F.col("nation").cast("string")
    return groups.select(
        "*", F.when(even, "football_data_org").otherwise("understat").alias("source"), F.lit("matches").alias("entity_type"),
        F.concat(F.lit("2025-09-0"), (F.col("nation") % 3 + 1).cast("string")).alias("date"),
        F.concat(F.when(even, "PL").otherwise("EPL"), F.lit("_2025_"), nation, F.lit("_"), "segment", F.lit("_120000_000001.json")).alias("file_name"),
        F.to_json(F.struct("nation", "segment", "n")).alias("payload"),
    )


@query("raw_tree_scan", f"""WITH {_SQL_DOCS}, placed AS (SELECT source || '/' || entity_type || '/' || date || '/' || file_name AS rel_path, source, entity_type, date, file_name FROM docs)
    SELECT 'all' AS listing, * FROM placed
    UNION ALL SELECT 'selected', * FROM placed WHERE source = 'understat' AND date = '2025-09-02'
    UNION ALL SELECT 'short', source || '/' || entity_type || '/' || file_name, NULL, NULL, NULL, NULL FROM docs WHERE nation % 7 = 0""")
def raw_tree_scan(spark, sf):
    """The tree listed whole, by source and date, and the files at paths that are too short."""
    root, docs = _folder(spark), _documents(spark, sf)
    save_documents(docs, root)
    save_documents(docs.filter("nation % 7 = 0").withColumn("date", F.lit(None).cast("string")), root)
    placed, short = discover_files(spark, root)
    some, _ = discover_files(spark, root, source="understat", date="2025-09-02")
    columns = ["rel_path", "source", "entity_type", "date", "file_name"]
    none = [F.lit(None).cast("string").alias(c) for c in columns[1:]]
    parts = [placed.select(F.lit("all").alias("listing"), *columns), some.select(F.lit("selected").alias("listing"), *columns), short.select(F.lit("short").alias("listing"), "rel_path", *none)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("raw_snapshots", f"""WITH {_SQL_DOCS} SELECT source || '/' || entity_type || '/' || date || '/' || file_name AS rel_path, nation, segment, n, true AS first_written, false AS second_written FROM docs""")
def raw_snapshots(spark, sf):
    """Documents saved twice: the second time nothing is overwritten."""
    root, docs = _folder(spark), _documents(spark, sf)
    first = save_documents(docs, root).withColumnRenamed("written", "first_written")
    second = save_documents(docs.withColumn("payload", F.lit("{}")), root).withColumnRenamed("written", "second_written")
    text = spark.read.option("recursiveFileLookup", True).schema("nation bigint, segment string, n bigint").json(root)
    path = F.regexp_extract(F.url_decode("_metadata.file_path"), r"([^/]+/[^/]+/[^/]+/[^/]+)$", 1)
    return text.select(path.alias("rel_path"), "nation", "segment", "n").join(first, "rel_path").join(second, "rel_path")


@query("raw_rows", f"WITH {_SQL_DOCS} SELECT source, entity_type, CAST(date AS DATE) AS date, nation, segment, 2 * n AS n FROM docs")
def raw_rows(spark, sf):
    """JSON rows appended twice below source, entity type and date."""
    root, docs = _folder(spark), _documents(spark, sf).select("source", "entity_type", "date", "nation", "segment", "n")
    save_raw(docs, root)
    save_raw(docs, root)
    keys = ["source", "entity_type", "date", "nation", "segment"]
    back = spark.read.schema("nation bigint, segment string, n bigint, source string, entity_type string, date date").json(root)
    return back.groupBy(*keys).agg(F.sum("n").alias("n"))


@query("stream_ingest", f"""WITH {_SQL_DOCS}, loaded AS (
      SELECT * FROM docs UNION ALL SELECT * REPLACE (n + 1000 AS n) FROM docs WHERE nation % 5 = 0)
    SELECT 'bronze' AS kind, source, entity_type, '2025-2026' AS season, 'premier-league' AS league, nation, segment, n, NULL AS reason FROM loaded
    UNION ALL SELECT 'quarantine', source, entity_type, NULL, NULL, NULL, NULL, count(*), 'invalid json' FROM docs WHERE nation % 5 = 2 GROUP BY ALL
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, NULL, NULL, NULL, count(*), 'short path' FROM docs WHERE nation % 5 = 3 HAVING count(*) > 0""")
def stream_ingest(spark, sf):
    """Two waves of files into bronze; the second edits files in place, repeats contents and brings broken and misplaced files."""
    base, docs = _folder(spark), _documents(spark, sf)
    root, target, side = f"{base}/raw", f"{base}/bronze", f"{base}/quarantine"
    renamed = lambda df, ending: df.withColumn("file_name", F.replace("file_name", F.lit("_000001.json"), F.lit(ending)))
    changed = docs.filter("nation % 5 = 0").withColumn("payload", F.to_json(F.struct("nation", "segment", (F.col("n") + 1000).alias("n"))))
    waves = [
        [(docs, False)],
        [(changed, True), (renamed(docs.filter("nation % 5 = 1"), "_000002.json"), False),
         (renamed(docs.filter("nation % 5 = 2"), "_000003.json").withColumn("payload", F.lit("{oops")), False),
         (docs.filter("nation % 5 = 3").withColumn("date", F.lit(None).cast("string")), False)],
    ]
    for wave in waves:
        for df, replace in wave:
            save_documents(df, root, replace)
        start_ingest(spark, root, target, side, f"{base}/state").awaitTermination()
    field = lambda name, kind: F.get_json_object("payload", f"$.{name}").cast(kind).alias(name)
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    rows = read_bronze(spark, target).select(
        F.lit("bronze").alias("kind"), "source", "entity_type", "season", "league", field("nation", "bigint"), field("segment", "string"), field("n", "bigint"), none("reason", "string"))
    bad = spark.read.schema("rel_path string, source string, entity_type string, reason string").parquet(side)
    bad = bad.groupBy("source", "entity_type", "reason").agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(bad.select(
        F.lit("quarantine").alias("kind"), "source", "entity_type", none("season", "string"), none("league", "string"), none("nation", "bigint"), none("segment", "string"), "n", "reason"))


@query("seed_scan", "SELECT 'understat' AS source, s_name AS raw_team_name, s_suppkey AS team_id FROM supplier UNION ALL SELECT 'statbunker', n_name, NULL FROM nation")
def seed_scan(spark, sf):
    """A reference file written as CSV and read with its declared types; empty cells are NULL."""
    folder = _folder(spark)
    a = table(spark, sf, "supplier").select(F.lit("understat").alias("source"), F.col("s_name").alias("raw_team_name"), F.col("s_suppkey").cast("string").alias("team_id"))
    b = table(spark, sf, "nation").select(F.lit("statbunker").alias("source"), F.col("n_name").alias("raw_team_name"), F.lit("").alias("team_id"))
    a.unionByName(b).write.option("header", True).option("emptyValue", "").csv(f"{folder}/team_name_map.csv")
    return read_seed(spark, folder, "team_name_map").withColumn("team_id", F.col("team_id").cast("bigint"))


@query("materialized_models", "SELECT o_orderstatus, count(*) AS in_table, 2 * count(*) AS in_view FROM orders GROUP BY 1")
def materialized_models(spark, sf):
    """A model built as a table, rebuilt, and a view over it that follows."""
    name, orders = f"model_{uuid.uuid4().hex}", table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    materialize(orders.limit(1), name)
    materialize(orders, name)
    built = spark.table(name)
    materialize(built.unionAll(built), f"{name}_view", as_view=True)
    count = lambda df, label: df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias(label))
    return count(built, "in_table").join(count(spark.table(f"{name}_view"), "in_view"), "o_orderstatus")


@query("chat_log", """SELECT 'c' || o_custkey AS conversation_id, 'm' || o_orderkey AS user_message, o_orderpriority AS model, CASE WHEN o_orderstatus = 'F' THEN 'SELECT 1' END AS sql_generated,
    CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'refused' END AS response, CAST(o_orderkey % 1000 AS BIGINT) AS prompt_tokens, CAST(o_totalprice AS BIGINT) / 1000000.0 AS cost_estimate_usd FROM orders""")
def chat_log(spark, sf):
    """Answered and refused requests appended to the log in two runs."""
    path, orders = _folder(spark), table(spark, sf, "orders")
    answered = F.col("o_orderstatus") == "F"
    log = orders.select(
        F.concat(F.lit("c"), "o_custkey").alias("conversation_id"), F.concat(F.lit("m"), "o_orderkey").alias("user_message"), F.col("o_orderpriority").alias("model"),
        F.when(answered, "SELECT 1").alias("sql_generated"), F.when(answered, "ok").otherwise("refused").alias("response"),
        (F.col("o_orderkey") % 1000).cast("int").alias("prompt_tokens"), F.lit(0).alias("completion_tokens"), F.lit(1).alias("latency_ms"),
        (F.rint("o_totalprice").cast("bigint") / F.lit(1000000)).cast("decimal(10,6)").alias("cost_estimate_usd"), F.current_timestamp().alias("created_at"))
    append_chat_log(log.filter("sql_generated is not null"), path)
    append_chat_log(log.filter("sql_generated is null"), path)
    back = spark.read.schema(CHAT_LOG).parquet(path).drop("completion_tokens", "latency_ms", "created_at")
    return back.withColumns({"prompt_tokens": F.col("prompt_tokens").cast("bigint"), "cost_estimate_usd": F.col("cost_estimate_usd").cast("double")})
