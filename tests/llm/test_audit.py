"""Filter interaction audit against plain Python."""

import random
from itertools import permutations

from touchline.llm import audit

DOCS = "doc_id bigint, text string, source string, mask int, n bigint, slot0 bigint, part string"
LABELS = "doc_id bigint, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute_force(docs, labels):
    def failed(doc_id, text):
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
        out = {"A"} if len(words) < 50 else set()
        out |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        out |= {"D"} if set(text) & set("#$%&*|") else set()
        twins = [i for i, t, _ in docs if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
        return out | ({"E"} if twins else set())

    rows = [(s or "", failed(i, t or ""), any(l[0] == i and i is not None and l[1] == 1 for l in labels), any(l[0] == i and i is not None and l[2] == 1 for l in labels)) for i, t, s in docs]
    out = []
    for part in {r[0] for r in rows}:
        mine, lines, total = [r for r in rows if r[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            gone = set()
            for step, f in enumerate(order, 1):
                here = [r for r in mine if f in r[1] and not r[1] & gone]
                redundant = sum(f in r[1] and bool(r[1] & gone) for r in mine)
                gone = gone | {f}
                kept = sum(not r[1] & gone for r in mine)
                total[f] += len(here)
                lines.append((part, "".join(order), step, kept, len(here), redundant, sum(r[1] == {f} for r in mine), sum(r[2] for r in here), sum(r[3] for r in here), f))
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_random_tables_with_full_and_overfull_sketch(spark):
    rng = random.Random(9)
    pool = [None, "", "A B", "x " * 60, " ".join(f"w{k}" for k in range(80)), "Ünï # " * 9, " ".join(f"v{k}\x0b\x85" for k in range(55)), "LOUD " + " ".join(f"w{k}" for k in range(60))]
    docs = [(rng.choice([None, *range(150)]), rng.choice([*pool, " ".join(rng.choices("abcdefghijkl", k=70)), f"own {k}"]), rng.choice([None, "", "s1", "s2"])) for k in range(300)]
    labels = [(rng.choice([None, *range(150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    df = spark.createDataFrame([(*d, 1, 2, 3, "p") for d in docs], DOCS).repartition(5)
    rated = spark.createDataFrame(labels, LABELS).withColumnRenamed("toxic", "toxic")
    want = brute_force(docs, labels)
    assert got(audit.audit(df, rated)) == want
    # a sketch far too small clears nothing and changes nothing
    assert got(audit.audit(df, rated, slots=1 << 15)) == want


def test_hot_text_and_repeated_rows(spark):
    docs = [(k, "same text", "s") for k in range(2000)] + [(0, "same text", "s"), (None, "same text", "s")] + [(9000, "long " * 50_000, "s")]
    counts = audit.mask_counts(audit.failures(spark.createDataFrame([(*d, 1, 2, 3, "p") for d in docs], DOCS)), spark.createDataFrame([], LABELS))
    # twice id 0 and once no id keep the text, the others repeat it
    assert sorted((r["mask"], r.n) for r in counts.collect()) == [(1, 3), (2, 1), (17, 1999)]


def test_empty_table(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, 1)], LABELS)
    assert audit.audit(docs, labels).collect() == []


def test_sketch_clears_texts_that_occur_once(spark):
    texts = spark.createDataFrame([(f"t{k}",) for k in range(500)] + [("twice",)] * 2, "text string")
    bitmap = audit.repeat_slots(texts, "text", 1 << 20)
    assert sum(b.bit_count() for b in bitmap) <= audit.PROBES + 3
