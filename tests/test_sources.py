import datetime as dt
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tests import fixtures
from touchline import registry, schemas
from touchline.plans.history import open_row_violations
from touchline.sources import bronze, files, pages, seeds, tables
from touchline.streaming import history as stream_history
from touchline.streaming import ingest as stream_ingest
from touchline.streaming.throttle import SETTINGS, throttle_stream


def counts(df):
    return tuple(df.first())


def test_ingest_is_idempotent_and_tolerant(spark, tmp_path, rows):
    root, target, tracked, bad, first = fixtures.load(spark, str(tmp_path))
    assert counts(first) == (9, 0, 0) and bad.count() == 0
    docs = bronze.read_bronze(spark, target)
    assert docs.filter("season = '2025-2026' and league = 'premier-league'").count() == 9
    again = bronze.ingest(spark, root, target, tracked)
    assert counts(again[2]) == (0, 0, 0)  # nothing pending
    rehash = bronze.ingest(spark, root, target, tracked, full_rehash=True)
    assert counts(rehash[2]) == (0, 9, 0) and bronze.read_bronze(spark, target).count() == 9

    day = "football_data_org/standings/2025-09-02"
    time.sleep(1.1)
    permuted = {k: fixtures.STANDINGS[k] for k in reversed(list(fixtures.STANDINGS))}
    fixtures.put(root, f"{day}/PL_2025_1_1.json", permuted)  # same content again
    fixtures.put(root, f"{day}/PL_2025_1_2.json", "{not json")
    fixtures.put(root, f"{day}/PL_latest_1_3.json", {"a": 1})
    fixtures.put(root, f"{day}/BL1_2025_1_4.json", {"a": 2})  # unknown league is kept
    with open(os.path.join(root, f"{day}/PL_2025_1_5.json"), "wb") as f:
        f.write(b'{"a": "\xff\xfe"}')
    fixtures.put(root, "stray/short.json", {"a": 3})
    tracked3, bad3, third = bronze.ingest(spark, root, target, tracked)
    assert counts(third) == (1, 1, 3)
    assert rows(bad3, "rel_path", "reason") == [
        (f"{day}/PL_2025_1_2.json", "invalid json"), (f"{day}/PL_2025_1_5.json", "invalid json"), (f"{day}/PL_latest_1_3.json", "bad season"), ("stray/short.json", "short path"),
    ]
    assert rows(bronze.read_bronze(spark, target).filter("league is null"), "season") == [(None,)]
    assert tracked3.count() == 11  # quarantined files are tried again next time
    assert rows(files.discover_files(spark, root)[1], "rel_path") == [("stray/short.json",)]
    assert files.discover_files(spark, root, source="understat")[0].count() == 2
    assert files.discover_files(spark, root, date="2025-09-02")[0].count() == 5


def test_staging_scans_only_its_partition(spark, tmp_path):
    from touchline.plans import staging

    _, target, *_ = fixtures.load(spark, str(tmp_path))
    plan = staging.primary_matches(bronze.read_bronze(spark, target))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "PushedFilters: []" in plan


def test_changed_file_is_pending_again(spark, tmp_path):
    seen = dt.datetime(2025, 1, 1)
    listing = spark.createDataFrame([("a", seen, 1), ("b", seen, 2), ("c", seen, 3), ("d", seen, 4)], "rel_path string, mtime timestamp, size_bytes bigint")
    old = spark.createDataFrame([("a", seen, 1), ("b", seen, 9), ("c", seen + dt.timedelta(seconds=1), 3)], "file_path string, mtime timestamp, size_bytes bigint")
    assert sorted(r[0] for r in files.pending_files(listing, old).select("rel_path").collect()) == ["b", "c", "d"]
    assert files.pending_files(listing, old, full_rehash=True).count() == 4


def test_read_seeds(spark, tmp_path):
    for name, ddl in schemas.SEEDS.items():
        header = ",".join(c.split()[0] for c in ddl.split(", "))
        (tmp_path / f"{name}.csv").write_text(header + "\n")
    (tmp_path / "player_extra_info.csv").write_text("player_id,nationality,date_of_birth,shirt_number\n65,Croatia,1994-05-06,8\n")
    got = seeds.read_seeds(spark, str(tmp_path))
    assert got["player_extra_info"].first() == (65, "Croatia", dt.date(1994, 5, 6), 8)
    assert set(got) == set(schemas.SEEDS)


def test_raw_sink_and_todays_collection(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([("s", "e", "2025-01-01", 1), ("s", "e", "2025-01-02", 2)], "source string, entity_type string, date string, v int")
    files.save_raw(df, root)
    files.save_raw(df, root)
    assert spark.read.json(root).count() == 4
    fixtures.put(root, "statbunker/player_stats/2025-09-01/PL_2025_77_120000_000005.json", [])
    listed, _ = files.discover_files(spark, root, source="statbunker")
    work = spark.createDataFrame([("PL", "2025", 77), ("PL", "2025", 78)], "code string, season string, club_id int")
    assert [r["club_id"] for r in files.not_collected_today(work, listed, "2025-09-01", "player_stats").collect()] == [78]


def test_versioned_table(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert table.latest_version() is None
    table.commit(spark.range(5).toDF("id"))
    table.commit(table.read().filter("id < 3"))  # reads the version it replaces
    assert (table.read().count(), table.read(table.first_version()).count(), table.latest_version()) == (3, 5, 2)
    got = tables.snapshot_summary(table.snapshots()).collect()
    assert [(r["version"], r["added_records"]) for r in got] == [(1, "5"), (2, "3")]
    assert table.files().agg(F.sum("record_count")).first()[0] == 3


def test_verify_counts_and_materialize(spark):
    assert tables.verify_counts(spark.range(3), spark.range(3)) == 3
    with pytest.raises(RuntimeError):
        tables.verify_counts(spark.range(3), spark.range(4))
    tables.materialize(spark.range(2), "mart_table")
    tables.replace_table(spark.range(4), "mart_table")
    tables.materialize(spark.range(3), "mart_view", as_view=True)
    assert spark.table("mart_table").count() == 4 and spark.table("mart_view").count() == 3


HTML = """<html><table class="other"><tbody><tr><td>x</td></tr></tbody></table>
<table class="table striped"><thead><tr><th>h</th></tr></thead><tbody>
<tr><td> 1 </td><td><a href="/club?comp_id=2&amp;club_id=77"><p> Brighton &amp; Hove </p></a></td>{cells}</tr>
<tr><td>2</td><td>no paragraph</td>{cells}</tr><tr><td>short</td></tr></tbody></table></html>"""


def test_league_page(spark):
    html = HTML.replace("{cells}", "".join(f"<td>{i}</td>" for i in range(3, 11)))
    got = pages.league_rows(spark.createDataFrame([(1, html), (2, None), (3, "<p>no table")], "id int, html string")).collect()
    assert [(r["id"], r["rank"], r["team"], r["club_id"], r["played"], r["points"]) for r in got] == [(1, "1", "Brighton & Hove", "77", "3", "10")]


def test_expected_goal_page(spark):
    cells = "".join(f"<td>{i}</td>" for i in range(2, 9))
    html = f"<table><tbody><tr><td>1</td><td><a>Lyon</a></td>{cells}<td>70.2<sup>+3.1</sup></td><td>12.5</td><td>60.1<sup>-1.4</sup></td></tr></tbody></table>"
    r = pages.expected_goal_rows(spark.createDataFrame([(html,)], "html string")).first()
    assert (r["team"], r["xG"], r["xGA"], r["xPTS"]) == ("Lyon", "70.2", "12.5", "60.1")
    assert pages.player_array(spark.createDataFrame([('{"players": [{"id": 1}]}',), ("{}",)], "body string")).collect() == [('[{"id":1}]',), ("[]",)]


@pytest.mark.parametrize("name", ["page_expected_goals", "page_league_rows", "page_scorer_rows"])
def test_pages_of_one_split_are_parsed_in_many_tasks(spark, name):
    got = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_plain_pages_are_read_as_the_parser_reads_them():
    cells = "<tr><td>1 &amp; 2</td><TD class=\"x\">a<p> b </p><a href=\"/c?x=1&amp;id=3\">c</a><sup>+1</sup><br/></TD></tr>"
    plain = f"<div><table class=\"nav\"><tr><td>no</td></tr></table></div><table class=\"big table\"><tbody>{cells}<tr></tr></tbody></table>"
    odd = ["<!-- <table> -->", "<title>t</title>", "<script>'<table>'</script>", "<img src=a>", "a < b"]
    parsed = []
    for page in [plain, plain + "<!x <table", *[o + plain for o in odd]]:
        parser = pages._FirstTable("table")
        try:
            parser.feed(page)
        except pages._Ended:
            pass
        assert pages._table_rows(page, "table") == parser.rows
        parsed.append(parser.rows)
    assert pages._plain_rows(plain, "table") == parsed[0] and all(pages._plain_rows(o + plain, "table") is None for o in odd)
    assert [len(r) for r in parsed[0]] == [2, 0] and parsed[0][0][1]["href"] == "/c?x=1&id=3"
    assert pages._table_rows("<table><tbody><tr><td>open", "table") == [] and pages._table_rows("<p>none</p>", None) == []


def test_stream_ingest_restarts_without_duplicates(spark, tmp_path):
    root, target, side = str(tmp_path / "raw"), str(tmp_path / "bronze"), str(tmp_path / "bad")
    fixtures.write_crawl(root)
    fixtures.put(root, "understat/standings/2025-09-01/EPL_2025_1_9.json", "{oops")
    run = lambda: stream_ingest.start_ingest(spark, root, target, side, str(tmp_path / "state")).awaitTermination()
    run()
    assert bronze.read_bronze(spark, target).count() == 9
    fixtures.put(root, "football_data_org/standings/2025-09-03/PL_2025_1_1.json", fixtures.STANDINGS)
    fixtures.put(root, "football_data_org/matches/2025-09-03/PL_2025_1_2.json", {"matches": fixtures.MATCHES[:2]})
    run()
    assert bronze.read_bronze(spark, target).count() == 10
    assert spark.read.parquet(side).filter("reason = 'invalid json'").count() == 1


def test_stream_history_skips_replayed_batches(spark, tmp_path, rows):
    ddl = "k string, v int, loaded timestamp_ntz"
    table = stream_history.history_table(spark, str(tmp_path / "hist"), spark.createDataFrame([], ddl), ["k"], ["v"])
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    stamps = iter(["2025-01-01", "2025-01-02"])

    def push(data):
        spark.createDataFrame(data, ddl).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ddl).parquet(src)
        stream_history.start_history(
            stream, table, ["k"], ["v"], "loaded", state, lambda batch: F.lit(next(stamps)).cast("timestamp")
        ).awaitTermination()

    push([("a", 1, dt.datetime(2025, 1, 1)), ("a", 2, dt.datetime(2025, 1, 1, 1)), ("b", 1, dt.datetime(2025, 1, 1))])
    push([("a", 3, dt.datetime(2025, 1, 2))])
    got = rows(table.read(), "k", "v", "valid_from", "valid_to")
    d1, d2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    assert got == [("a", 2, d1, d2), ("a", 3, d2, None), ("b", 1, d1, None)]
    assert rows(table.read(1), "k", "v", "valid_to") == [("a", 2, None), ("b", 1, None)]
    batch = spark.createDataFrame([("a", 9)], "k string, v int")
    done = table.snapshots().filter("version = 2").first().operation.rsplit("-batch-", 1)
    assert stream_history.apply_batch(table, batch, done[0], int(done[1]), ["k"], ["v"], F.current_timestamp()) is False
    assert open_row_violations(table.read(), ["k"]).count() == 0
    # batch 1 of another stream is another batch, and a stream without a name is refused
    assert stream_history.apply_batch(table, batch, "other", 1, ["k"], ["v"], F.lit("2025-01-03").cast("timestamp")) is True
    assert rows(table.open_rows(), "k", "v") == [("a", 9), ("b", 1)]
    with pytest.raises(ValueError):
        stream_history.apply_batch(table, batch, "", 1, ["k"], ["v"], F.current_timestamp())


def test_history_commits_read_and_write_open_rows_only(spark, tmp_path):
    table = tables.HistoryTable(spark, str(tmp_path / "hist"), "k int, v int, valid_from timestamp, valid_to timestamp")
    now = lambda n: F.lit(f"2025-01-{n:02d}").cast("timestamp")
    for n in range(1, 5):
        batch = spark.range(20).select(F.col("id").cast("int").alias("k"), F.lit(n).alias("v"))
        assert stream_history.apply_batch(table, batch, "s", n, ["k"], ["v"], now(n))
    sizes = [(r.summary["closed-records"], r.summary["open-records"]) for r in table.snapshots().orderBy("version").collect()]
    assert sizes == [("0", "20"), *[("20", "20")] * 3]
    assert table.read().count() == 80 and table.read(2).count() == 40
    plan = table.open_rows()._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_open", plan) and re.search(r"PartitionFilters: \[[^\]]*_commit", plan)


def test_two_writers_cannot_take_one_version(spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "hist"), "k int, v int, valid_from timestamp, valid_to timestamp"
    mine, other = tables.HistoryTable(spark, path, ddl), tables.HistoryTable(spark, path, ddl)
    row = lambda v: spark.createDataFrame([(1, v)], "k int, v int")
    at = lambda n: F.lit(f"2025-01-0{n}").cast("timestamp")
    stream_history.apply_batch(mine, row(1), "a", 0, ["k"], ["v"], at(1))
    commit, raced = mine.commit, []

    def late(base, versions, operation):
        if not raced:
            raced.append(stream_history.apply_batch(other, row(2), "b", 0, ["k"], ["v"], at(2)))
        return commit(base, versions, operation)

    monkeypatch.setattr(mine, "commit", late)
    assert stream_history.apply_batch(mine, row(3), "a", 1, ["k"], ["v"], at(3)) is True
    got = sorted((r.v, r.valid_to is None) for r in mine.read().collect())
    assert got == [(1, False), (2, False), (3, True)] and mine.latest_version() == 3
    versions = tables.VersionedTable(spark, str(tmp_path / "t"))
    versions.commit(row(1))
    with pytest.raises(tables.VersionTaken):
        versions.claim(1, "replace", "x", {})


def judge_stream(spark, tmp_path, parts, window, limit, pause=0):
    """Verdicts by id after every part went through one trigger."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ddl = "k string, ts timestamp_ntz, id bigint"
    for data in parts:
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(src)
        judged = throttle_stream(spark.readStream.schema(ddl).parquet(src), "k", "ts", "id", window, limit)
        judged.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        time.sleep(pause)
    return {r["id"]: r["accepted"] for r in spark.read.parquet(out).collect()}, state


BASE = dt.datetime(2025, 1, 1)


def test_stream_throttle_keeps_state_between_triggers(spark, tmp_path):
    parts = [[("a", BASE + dt.timedelta(seconds=t), t) for t in part] for part in ([20, 0, 10], [30, 61, 90])]
    parts[0] += [(None, BASE, 1000), ("a", None, 1001)]
    parts[1] += [(None, BASE + dt.timedelta(seconds=1), 1002), (None, BASE + dt.timedelta(seconds=2), 1003)]
    got, _ = judge_stream(spark, tmp_path, parts, 60, 2)
    assert got == {0: True, 10: True, 20: False, 30: False, 61: True, 90: True, 1000: True, 1001: False, 1002: True, 1003: False}


def test_stream_throttle_state_is_empty_after_the_window(spark, tmp_path):
    parts = [[(f"k{n}", BASE, n) for n in range(20)], [("last", BASE, 100)]]
    got, state = judge_stream(spark, tmp_path, parts, 2, 1, pause=4)
    assert all(got.values()) and len(got) == 21
    held = spark.read.format("statestore").option("stateVarName", "log").load(state)
    assert [r.key[0] for r in held.select("key").collect()] in (["=last"], [])
