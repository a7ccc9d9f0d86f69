"""Ranked lexical search against full scoring in plain Python."""

import math
import random
import re

import numpy as np
import pytest

from touchline.llm import lexical

DOCS = "doc_id bigint, text string, n int, terms string, item string, query string"


def split(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def full_scoring(docs, items, k):
    """Every score of every document, by the definition."""
    bags = [(doc_id, split(text)) for doc_id, text in docs]
    n_docs, total = sum(bool(ws) for _, ws in bags), sum(len(ws) for _, ws in bags)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(split(text))
    df = {t: sum(t in ws for _, ws in bags) for t in set().union(*asked.values())}
    out = []
    for item_id, wanted in asked.items():
        scores = []
        for doc_id, ws in bags:
            score = 0
            for t in wanted:
                if tf := ws.count(t):
                    m = 100 - 90 + (90 * len(ws) * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, doc_id, -s) for r, (s, _, _, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranked(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def make(rng, rows, words, most):
    weights = [1 / (w + 1) for w in range(words)]
    names = ["Ab9", "ß", "ünï", *(f"w{w}" for w in range(3, words))]
    return [" ".join(rng.choices(names, weights, k=rng.randint(0, most))).replace(" ", rng.choice([" ", "-", "\n", "_"])) for _ in range(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    docs = [(rng.choice([None, *range(200)]), rng.choice([None, t, t, t])) for t in make(rng, 300, 40, 60)]
    docs += [(1000 + k, "same words here") for k in range(30)] + [(5000, "w5 " * 4000)]
    items = [(rng.choice([None, *range(12)]), t) for t in make(rng, 20, 45, 12)] + [(90, None), (91, ""), (92, "same here"), (93, "unheard of")]
    df = spark.createDataFrame([(*d, 1, "a", "b", "c") for d in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(*i, 7) for i in items], "item_id int, text string, doc_id int")
    got = lexical.search(df, asked, k=5, segment_docs=32, block_terms=40)
    assert ranked(got) == full_scoring(docs, items, 5)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.search(docs, items).collect() == [] == lexical.search(docs, some).collect()
    assert lexical.search(spark.createDataFrame([(1, "a", 1, "", "", "")], DOCS), items).collect() == []


def segment(rng, docs, vocabulary, per_doc):
    """A segment and its contributions as a dense table."""
    sizes = [rng.randint(0, per_doc) for _ in range(docs)]
    term = np.array([t for n in sizes for t in rng.sample(range(vocabulary), n)], np.int64)
    tf = np.array([rng.randint(1, 3) for _ in term], np.int64)
    weights = np.array([rng.choice([0, 3, 50, 900]) for _ in range(vocabulary)], np.int64)
    block = lexical.Block({}, weights, [], docs, max(sum(sizes), 1), 4)
    made = lexical.Segment(block, np.arange(docs), sizes, np.concatenate([[0], np.cumsum(sizes)]), term, tf)
    table = np.zeros((docs, vocabulary), np.int64)
    table[made.doc, made.term] = made.impact
    return made, table


def test_segments_equal_full_scores_whatever_the_step(monkeypatch):
    rng = random.Random(3)
    none = np.zeros(0, np.int64)
    for step in (1, 2, 16):
        monkeypatch.setattr(lexical, "FIRST_STEP", step)
        for _ in range(40):
            made, table = segment(rng, rng.randint(1, 60), 12, 8)
            for _ in range(5):
                query = np.array(sorted(rng.sample(range(12), rng.randint(1, 6))))
                (scores, ids), met = made.best(query, 4, (none, none))
                full = table[:, query].sum(axis=1)
                want = sorted((-s, d) for d, s in enumerate(full) if s > 0)[:4]
                assert list(zip(-scores, ids)) == want and met <= (full > 0).sum()
                assert not made.seen.any() and not made.asked.any()


def test_best_positions_move_over_documents_met_in_other_lists():
    made, _ = segment(random.Random(4), 400, 12, 8)
    start, size = made.start[:3], made.size[:3]
    lists = [made.list_doc[s : s + n] for s, n in zip(start, size)]
    made.seen[np.concatenate([lists[0][:40], lists[1][:3]])] = True
    want = [next((k for k, d in enumerate(docs) if not made.seen[d]), len(docs)) for docs in lists]
    assert list(made._best_positions(start, size, np.zeros(3, np.int64), window=4)) == want and want[0] >= 40 and want[1] >= 3


def test_a_query_stops_without_meeting_all_documents():
    made, table = segment(random.Random(4), 3000, 12, 8)
    none = np.zeros(0, np.int64)
    (scores, _), met = made.best(np.array([0, 1]), 4, (none, none))
    assert len(scores) == 4 and met < (table[:, :2].sum(axis=1) > 0).sum() / 2
    # a score carried over that nothing here reaches stops the query after its first positions
    _, met = made.best(np.array([0, 1]), 1, (np.array([10**12]), np.array([7])))
    assert met <= 2 * lexical.FIRST_STEP
