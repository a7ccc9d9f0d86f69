"""Site templates against a plain count over generated hosts; fingerprints of edited texts and of hot ids."""

import math
import random

import pytest

from touchline.llm import html_text, simhash

PAGES = "page_id long, url string, html string, page long, host string, keys string"


def generated_hosts(rng):
    """Pages of four hosts: own paragraphs, a box on a share of the pages, a passage that some articles quote."""
    rows, boxes = [], {"ten": (100, 0.1), "third": (30, 1 / 3), "few": (60, 0.03), "all": (12, 1.0)}
    for host, (pages, share) in boxes.items():
        with_box = set(rng.sample(range(pages), max(2, round(pages * share))))
        quoting = set(rng.sample(range(pages), max(1, pages // 6)))
        for k in range(pages):
            box = f"<div><span>Box of {host}</span> <b>join us</b></div>" if k in with_box else ""
            quote = f"<p>A passage quoted on {host}</p>" if k in quoting else ""
            own = [f"{host} sentence {k} {rng.random()}" for _ in range(3)]
            rows.append((host, k, box, quote, own, rng.random() < 0.5))
    return rows


def test_boxes_on_few_pages_of_a_host_go_and_quoted_passages_stay(spark):
    rows = generated_hosts(random.Random(8))
    data, want, on_pages, articles = [], {}, {}, {}
    for host, k, box, quote, own, first in rows:
        body = "".join(f"<p>{t}</p>" for t in own)
        inner = box + body + quote if first else body + quote + box
        data.append((len(data), f"https://{host}.example/{k}", f"<html><body><nav>menu</nav><article><h1>{own[0]}</h1>{inner}</article></body></html>", 1, "h", "k"))
        articles[host] = articles.get(host, 0) + 1
        on_pages[host] = on_pages.get(host, 0) + bool(box)
    for (host, _, box, quote, own, first), (page_id, *_) in zip(rows, data):
        template = on_pages[host] >= max(5, math.ceil(math.log2(articles[host])))
        shown = [f"Box of {host} join us"] if box and not template else []
        quoted = [f"A passage quoted on {host}"] if quote else []
        want[page_id] = "\n".join([own[0], *(shown + own + quoted if first else own + quoted + shown)])
    assert [on_pages[h] >= max(5, math.ceil(math.log2(articles[h]))) for h in ("ten", "third", "few", "all")] == [True, True, False, True]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, PAGES)).collect()}
    assert got == want


@pytest.mark.parametrize("markup, text", [
    ('<h2 id="Related_work">Related</h2><p>x</p>', "Related\nx"), ('<section id="Social_history"><p>s</p></section>', "s"),
    ('<div class="article-header"><h1>T</h1></div>', "T"), ('<p class="comment">c</p>', "c"), ('<div id="banner-history">b</div>', "b"),
    ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p>", "a x=1 b"), ("<p>a</p><xmp>&amp; <b></xmp>", "a\n&amp; <b>"),
    ('<div class="post-comments">no</div><ul class="relatedPosts"><li>no</li></ul><div id="siteFooter">no</div><p>y</p>', "y"),
    ('<p class="advert">no</p><div class="cookie-notice">no</div><div class="share-buttons">no</div><div class="user-reply">no</div>z', "z"),
])
def test_names_that_mark_and_names_that_do_not(markup, text):
    assert html_text.Page(f"<body><article>{markup}</article></body>").text("", frozenset()) == text


def test_teasers_are_not_the_article():
    page = '<body><article class="teaser">T</article><div><p>The text itself</p></div></body>'
    assert html_text.Page(page).text("", frozenset()) == "T\nThe text itself"
    both = '<body><article class="teaser">T</article><article><p>The text itself</p></article></body>'
    assert html_text.Page(both).text("", frozenset()) == "The text itself"
    with pytest.raises(ValueError):
        html_text.extract(None, keep=["text"])


def jaccard(a, b):
    x, y = ({tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_edited_copies_lie_within_the_radius():
    """Copies with single words replaced, down to four fifths of the five-word shingles: nine in ten are found, strangers never."""
    rng, hasher = random.Random(6), simhash.Hasher()
    vocabulary = [f"word{k}" for k in range(4000)]
    weights = [1 / (k + 3) for k in range(4000)]
    mark = lambda ws: int(simhash.fingerprint(hasher.words(" ".join(ws))).hex(), 16)
    found, marks = [], []
    for n in [50, 100, 250, 600] * 30:
        base = rng.choices(vocabulary, weights, k=n)
        copy = list(base)
        for at in rng.sample(range(n), n):
            kept, copy[at] = copy[at], rng.choice(vocabulary)
            if jaccard(base, copy) < 0.8:
                copy[at] = kept
                break
        marks.append(mark(base))
        found.append((marks[-1] ^ mark(copy)).bit_count() <= simhash.RADIUS)
    assert sum(found) >= 0.9 * len(found)
    assert min((a ^ b).bit_count() for k, a in enumerate(marks) for b in marks[:k]) > simhash.RADIUS


def test_rows_of_one_id_and_without_id_are_cut_into_ranges(spark):
    rows = [(7, f"text number {k} of a hot id") for k in range(900)] + [(None, f"nameless {k}") for k in range(900)] + [(k, "same") for k in range(5)]
    df = spark.createDataFrame([(i, t, 0, "m") for i, t in rows], "doc_id long, text string, slot int, fingerprint string").repartition(7).cache()
    got = simhash.with_next(df, ranges=40)
    sizes = [r["n"] for r in got.selectExpr("spark_partition_id() AS p").groupBy("p").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()]
    assert sum(sizes) == len(rows) and len(sizes) > 20 and max(sizes) < len(rows) / 5
    # every row is followed by exactly one other: fingerprints and those of the followers are the same rows
    assert sorted(r[0] for r in got.select("fingerprint").collect()) == sorted(r[0] for r in got.select("next_fingerprint").collect())


def test_within_radius_lists_classes(spark):
    marks = spark.createDataFrame([(3, "0" * 32), (1, "0" * 32), (9, "0" * 31 + "3"), (5, "f" * 32)], "doc_id long, fingerprint string")
    got = simhash.within_radius(marks, marks.filter("doc_id = 3")).collect()
    assert sorted((r.near_id, r["rows"], r.distance) for r in got) == [(1, 2, 0), (9, 1, 2)]
    with pytest.raises(ValueError):
        simhash.within_radius(marks, marks, radius=16)


def test_search_broadcasts_no_table_larger_than_allowed(spark):
    """A small table of fingerprints becomes 136 rows each: 0.2 MB known to Spark, some 40 MB to look up."""
    rng = random.Random(8)
    marks = spark.createDataFrame([(k, f"{rng.getrandbits(128):032x}") for k in range(3000)], "doc_id long, fingerprint string")
    limits = {"spark.sql.autoBroadcastJoinThreshold": "10m", "spark.sql.maxBroadcastTableSize": "16m"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        found = simhash.within_radius(marks, marks).select("fingerprint", "near", "distance").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(found) == sorted((r.fingerprint, r.fingerprint, 0) for r in marks.collect())


def test_places_are_drawn_on_the_executors(spark):
    """The driver gets the rows drawn and no more; the first rows of a sorted table are sent to it by every task."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "xxhash64(id) AS tie", "id AS row").repartition(40)
    drawn = simhash._drawn(docs, 200)
    assert "TakeOrdered" not in drawn._jdf.queryExecution().executedPlan().toString()
    rows = drawn.collect()
    assert 190 <= len(rows) <= 200 and len({r.row for r in rows}) == len(rows) and all(r.doc_id == r.row for r in rows)
    places = simhash._places(docs, 10)
    assert len(places) == 9 and places == sorted(places) and all(100 < p[1] < 4900 for p in places)
