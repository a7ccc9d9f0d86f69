import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.functions.text import gram_similarity, trigrams, unaccent
from touchline.operators import joins, matching, mentions, ranking, scans
from touchline.operators.throttle import settle_slices, throttle

DAY = dt.datetime(2024, 1, 1)


def events(spark, n=600, seed=3):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        data.append((key, DAY + dt.timedelta(hours=rng.randrange(400)), i, rng.choice([None, 1, 2, 5])))
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint, x bigint")


@pytest.mark.parametrize("places", [1, 12])
def test_running_totals_equal_a_window(spark, rows, places):
    df = events(spark).cache()
    order = [F.col("ts").asc(), F.col("id").asc()]
    got = scans.running_totals(df, ["k"], [F.col("ts"), F.col("id")], {"total": "x"}, "nth", places=places)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"total": F.sum("x").over(w), "nth": F.count(F.lit(1)).over(w)})
    cols = ["k", "ts", "id", "x", "total", "nth"]
    assert rows(got, *cols) == rows(want, *cols)


def test_heavy_keys_are_cut_at_tie_breaks(spark, rows):
    data = [("zero", n, 0) for n in range(3000)] + [(f"k{n % 300}", n, n) for n in range(3000)]
    df = spark.createDataFrame(data, "k string, id int, points int")
    order = [*scans.falling("points"), F.col("id")]
    cuts = scans.key_places(df, ["k"], F.struct(*order), places=16).collect()
    assert [r["_k0"] for r in cuts] == ["zero"] and 4 <= len(cuts[0]["_cuts"]) <= 12
    parts = scans._with_parts(df, ["k"], F.struct(*order), scans.key_places(df, ["k"], F.struct(*order), places=16))
    assert parts.filter("k = 'zero'").groupBy("_part").count().agg(F.max("count")).first()[0] < 1500
    got = scans.rank_within(df, ["k"], order, places=16)
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("points"), "id")).cast("bigint"))
    assert rows(got, "k", "id", "position") == rows(want, "k", "id", "position")


def test_parts_are_found_by_bisection(spark):
    data = [("zero", n % 7, n) for n in range(2000)] + [("one", n, n) for n in range(5)] + [(None, 0, 0)]
    df = spark.createDataFrame(data, "k string, points int, id int")
    order = F.struct(*scans.falling("points"), F.col("id"))
    cuts = scans.key_places(df, ["k"], order, places=13)
    [(places,)] = cuts.select("_cuts").collect()
    parts = scans._with_parts(df, ["k"], order, cuts, 13)
    want = {n: sum((p[0], p[1], p[2]) < (False, -(n % 7), n) for p in places) for n in range(2000)}
    assert {r.id: r._part for r in parts.filter("k = 'zero'").collect()} == want and len(places) > 8
    assert parts.filter("_part is null").count() == 6
    assert scans._with_parts(df, ["k"], order, cuts, 13, "inner").count() == 2000
    plan = scans.rank_within(df, ["k"], [*scans.falling("points"), F.col("id")])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "_order" not in plan.split("Window")[0]


def test_rank_within_equals_row_number(spark, rows):
    df = events(spark)
    got = scans.rank_within(df, ["k"], [*scans.falling("x"), F.col("id")], places=9)
    order = [F.col("x").desc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
    assert rows(got, "id", "position") == rows(want, "id", "position")
    empty = scans.rank_within(df.limit(0), ["k"], [F.col("id")])
    assert empty.columns == [*df.columns, "position"] and empty.count() == 0


@pytest.mark.parametrize("places", [1, 15])
def test_as_of_join_against_brute_force(spark, rows, places):
    facts = events(spark, 200, 1).withColumnsRenamed({"ts": "at", "id": "fact"}).drop("x")
    probes = events(spark, 300, 2).drop("x")
    got = scans.as_of_join(probes, facts, ["k"], "ts", "at", ["fact"], places=places)
    known = [tuple(r) for r in facts.select("k", "at", "fact").collect()]
    want = []
    for k, ts, i in probes.select("k", "ts", "id").collect():
        hits = [(at, f) for fk, at, f in known if fk == k and at <= ts]
        want.append((i, *(max(hits)[::-1] if hits else (None, None))))
    assert rows(got, "id", "fact", "at") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_as_of_join_carries_over_parts_without_facts(spark, rows):
    facts = spark.createDataFrame([("a", DAY, 1)], "k string, at timestamp_ntz, fact int")
    probes = spark.createDataFrame([("a", DAY + dt.timedelta(days=n - 3), n) for n in range(2000)], "k string, ts timestamp_ntz, id int")
    got = scans.as_of_join(probes, facts, ["k"], "ts", "at", places=20)
    assert rows(got, "id", "fact") == sorted([(n, 1 if n >= 3 else None) for n in range(2000)], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_valid_at_join(spark, rows):
    history = spark.createDataFrame(
        [("a", DAY, DAY + dt.timedelta(days=2), "v1"), ("a", DAY + dt.timedelta(days=2), None, "v2"), ("b", DAY, DAY + dt.timedelta(days=1), "w")],
        "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string",
    )
    at = [("a", DAY), ("a", DAY + dt.timedelta(days=2)), ("a", DAY - dt.timedelta(days=1)), ("b", DAY + dt.timedelta(days=1)), ("c", DAY)]
    probes = spark.createDataFrame(at, "k string, t timestamp_ntz")
    got = scans.valid_at_join(probes, history, ["k"], "t", "valid_from", "valid_to")
    assert rows(got, "k", "v") == [("a", "v1"), ("a", "v2")]


def test_valid_at_join_returns_every_overlapping_version(spark, rows):
    rng = random.Random(7)
    moment = lambda: DAY + dt.timedelta(microseconds=rng.choice([rng.randrange(50), rng.randrange(10**12)]))
    versions = [(rng.choice("ab"), (f := moment()), rng.choice([None, f, f + dt.timedelta(microseconds=1), moment(), dt.datetime(1901, 1, 1)]), n) for n in range(300)]
    versions += [("a", dt.datetime(1900, 1, 1), dt.datetime(2999, 1, 1), 900), ("a", None, None, 901), (None, DAY, None, 902)]
    at = [(rng.choice(["a", "b", None]), rng.choice([moment(), None, dt.datetime(1950, 1, 1)]), n) for n in range(200)]
    history = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")
    got = scans.valid_at_join(spark.createDataFrame(at, "k string, t timestamp_ntz, id int"), history, ["k"], "t", "valid_from", "valid_to")
    want = [(i, v) for k, t, i in at for vk, f, to, v in versions if k and k == vk and t and f and f <= t and (to is None or t < to)]
    assert sorted((r.id, r.v) for r in got.collect()) == sorted(want) and len(want) > 1000


def test_versions_of_many_lengths_need_few_lengths_of_bins(spark):
    day = 86400 * 10**6
    lengths = [1, 2, 3, 4, 5, 16, 17, 2**62] + [day * 2**n + e for n in range(12) for e in (-1, 0, 1)]
    got = dict(spark.createDataFrame([(n,) for n in lengths], "n long").select("n", scans.bin_digits(F.col("n"))).collect())
    assert all(2**d < 4 * n and n <= 4 * 2**d for n, d in got.items())
    assert len({d for n, d in got.items() if day - 1 <= n < 2**60}) == 3  # each is a copy of every probe; twelve before


def test_topk_limits_before_the_shuffle(spark):
    top = ranking.topk_per_key(events(spark), ["k"], [F.col("ts").desc(), F.col("id").desc()], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.groupBy("k").count().agg(F.max("count")).first()[0] == 2


def test_unique_name_index_drops_shared_names(spark, rows):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, "b")], "id int, name string")
    assert rows(ranking.unique_name_index(df, F.lower("name"), "id")) == [("b", 3)]


def test_not_in_is_three_valued(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    one = spark.createDataFrame([(1,)], "b int")
    assert rows(joins.not_in(left, "a", one, "b")) == [(2,)]
    assert rows(joins.not_in(left, "a", one.unionByName(spark.createDataFrame([(None,)], "b int")), "b")) == []
    assert len(rows(joins.not_in(left, "a", one.limit(0), "b"))) == 3


def test_first_match_prefers_earlier_lookup_and_ignores_null(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, name string")
    by_id = spark.createDataFrame([(1, 100)], "id int, v int")
    by_name = spark.createDataFrame([("x", 7), ("y", 8)], "name string, v int")
    got = joins.first_match(df, [(by_id, {"id": F.col("id")}, "v"), (by_name, {"name": F.col("name")}, "v")], "hit")
    assert rows(got, "id", "hit") == [(1, 100), (2, 8), (3, None)]


NAMES = ["Arsenal FC", "Paris Saint-Germain FC", "Olympique Lyonnais", "Köln", "100% Sport", "AS_Monaco", "Stade Brestois 29", "Brest", "a\\b"]


@pytest.mark.parametrize("query", ["ars", "ô", "fc", "n", "100%", "s_m", "%", "_____", "b%t", "ol%ny", "zz", "\\", "o"])
def test_substring_join_matches_ilike(spark, rows, query):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    asked = spark.createDataFrame([(query,)], "q string")
    folded = {n: spark.range(1).select(F.lower(unaccent(F.lit(n)))).first()[0] for n in NAMES + [query]}
    pattern, body, i = "", folded[query], 0
    like = "%" + body + "%"
    while i < len(like):
        if like[i] == "\\" and i + 1 < len(like):
            pattern += re.escape(like[i + 1])
            i += 2
            continue
        pattern += {"%": ".*", "_": "."}.get(like[i], re.escape(like[i]))
        i += 1
    want = sorted((query, n) for n in NAMES if re.fullmatch(pattern, folded[n], re.S))
    assert rows(matching.substring_join(asked, "q", names, "name")) == want


def test_similarity_join_equals_all_pairs(spark, rows):
    rng = random.Random(5)
    words = ["arsenal", "paris", "lyon", "monaco", "brest", "fc", "sport", "as"]
    names = spark.createDataFrame([(" ".join(rng.sample(words, 3)),) for _ in range(60)] + [("fc",)] * 40, "name string")
    asked = spark.createDataFrame([("arsnal fc",), ("pariss",), ("monaco as",), ("",), ("lyon",)], "q string")
    got = matching.similarity_join(asked, "q", names, "name", 0.3)
    pairs = asked.crossJoin(names.distinct()).withColumn("s", gram_similarity(trigrams("q"), trigrams("name")))
    want = pairs.filter(F.col("s").cast("double") > 0.3)
    assert rows(got, "q", "name", "similarity") == rows(want, "q", "name", "s")


def brute_mentions(message, aliases):
    text, hits = message.lower(), []
    for alias, entity in aliases:
        for m in re.finditer(r"\b" + re.escape(alias) + r"\b", text):
            hits.append((m.end() - m.start(), m.start(), m.end(), alias, entity))
    kept = []
    for h in sorted(hits, key=lambda h: (-h[0], h[1], h[3])):
        if not any(h[1] < k[2] and h[2] > k[1] for k in kept):
            kept.append(h)
    seen, out = set(), []
    for h in sorted(kept, key=lambda h: h[1]):
        if h[4] not in seen:
            seen.add(h[4])
            out.append((h[4], h[3]))
    return out


def test_mentions_against_brute_force(spark):
    aliases = [("mu", 66), ("man united", 66), ("man city", 65), ("man", 1), ("pháo thủ", 57), ("city of light", 9), ("united city", 5)]
    messages = [
        "Pháo thủ đang đứng thứ mấy?", "tôi muốn xem", "MU vs Man United", "Man City beats man, man!", "man united city of light",
        "", "MAN  CITY", "mu.mu mu-man_city (man city)", "the city of light of man city of light",
    ]
    texts = spark.createDataFrame(list(enumerate(messages)), "id int, t string")
    dictionary = spark.createDataFrame(aliases, "alias string, entity_id int")
    got = {}
    for r in mentions.resolve_mentions(texts, "id", "t", dictionary).orderBy("id", "mention_rank").collect():
        got.setdefault(r["id"], []).append((r["entity_id"], r["alias"]))
    assert got == {i: m for i, m in ((i, brute_mentions(t, aliases)) for i, t in enumerate(messages)) if m}


def brute_throttle(data, window, limit):
    logs, out = {}, {}
    for k, t, i in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        log = logs.setdefault(k, [])
        while log and t - log[0] > window:
            log.pop(0)
        out[i] = len(log) < limit
        if out[i]:
            log.append(t)
    return out


@pytest.mark.parametrize("slices", [1, 4])
def test_throttle_with_a_saturated_key(spark, slices):
    rng = random.Random(11)
    data = [("hot", rng.randrange(2000), i) for i in range(500)]  # always busy: verdicts chain over all slices
    data += [(rng.choice(["a", "b", None]), rng.randrange(5000), i) for i in range(500, 900)]
    data += [("burst", 70, i) for i in range(900, 940)]
    df = spark.createDataFrame([(k, DAY + dt.timedelta(seconds=t), i) for k, t, i in data], "k string, ts timestamp_ntz, id bigint")
    got = {r["id"]: r["accepted"] for r in throttle(df, "k", "ts", "id", 60, 3, windows_per_slice=slices).collect()}
    assert got == brute_throttle(data, 60, 3)


def test_throttle_tenth_and_eleventh(spark):
    times = [0] * 10 + [60, 61]  # an event 60 s old still counts, at 61 s it has expired
    df = spark.createDataFrame([("ip", DAY + dt.timedelta(seconds=t), i) for i, t in enumerate(times)], "k string, ts timestamp_ntz, id bigint")
    got = [r["accepted"] for r in throttle(df, "k", "ts", "id", 60, 10).orderBy("id").collect()]
    assert got == [True] * 10 + [False, True]


def test_a_key_that_never_pauses_settles_in_logarithmic_rounds(spark):
    """Each accepted time decides the next one, so no slice forgets what the first event was."""
    window, slices = 1000, 64
    rng, t, data = random.Random(2), 0, []
    while t < window * slices:
        data.append(("hot", t // window, t, 1))
        t += rng.randrange(380, 420)
    data += [("calm", n, n * window, 1) for n in (0, 1, 5, 6)]
    grains = spark.createDataFrame(data, "k string, slice bigint, t bigint, n bigint")
    pasts, rounds = settle_slices(grains, window, 1)
    assert rounds <= 8
    log, want = [], {}
    for k, s, at, _ in data[:-4]:
        log = [x for x in log if at - x <= window]
        want.setdefault(s, list(log))
        if not log:
            log.append(at)
    got = {r.slice: list(r.past or []) for r in pasts.filter("k = 'hot'").collect()}
    assert got == want
