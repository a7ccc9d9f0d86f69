"""Ordinal quality classifier: cumulative-link regression on graded ratings over hashed text features.

One weight vector over hashed features gives a document's score s; ordered thresholds t_1 < t_2 < ... turn it into
P(grade >= k) = 1 / (1 + exp(t_k - s)). So grades share what is learned, the expected grade is the sum of the tails, and any
tail can be used for selection.

The model is fitted on a bounded sample of the rated documents (``SAMPLE`` in expectation, by a hash of the id), in equal parts
of each grade as far as a grade has that many; a rating counts by how many it stands for, so the probabilities are those of
the whole. Each shard runs over its rows from the current weights and the changes are averaged over the shards that touched a
feature. Model and sample do not grow with the input; scoring streams over every text without a shuffle.

Features are the distinct words (lower case, without outer punctuation) and their beginnings, the shapes of words by their share in the text, how
varied the words are, and whether there are any. Null and empty texts have the last only. Rows repeated among the ratings
count again; ratings without grade, and documents without rating, do not take part in fitting. Without any rating the weights
are zero. Long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, possible_rows

#: Hashed dimensions, rated documents used for fitting (in expectation), shards, rounds of averaging, passes per round.
DIMENSIONS, SAMPLE, SHARDS, ROUNDS, PASSES = 1 << 30, 10_000, 4, 12, 2
#: Sampled documents that a feature must occur in, learning rate (texts have hundreds of features that move together), pull towards zero.
LEAST, RATE, SHRINK = 5, 0.05, 0.02
#: Lengths of word beginnings that are features of their own, for what inflected and compound words share.
STEMS = (4, 5, 6)
_LETTERS = re.compile(r"[^\W\d_]+")
_OUTER = re.compile(r"^\W+|\W+$")


@dataclass(frozen=True)
class Model:
    """Hashed features in ascending order, their weights, and the thresholds."""

    slots: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: float) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        return [1 / (1 + math.exp(min(50.0, max(-50.0, t - score)))) for t in self.thresholds]


def _slot(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) % DIMENSIONS


class Featurizer:
    """Distinct hashed features of a text, or their places among the ``slots`` of a model; words seen lately are kept."""

    def __init__(self, slots: np.ndarray | None = None, most: int = 300_000):
        self.most, self.known = most, {}
        self.place = None if slots is None else {int(s): k for k, s in enumerate(slots)}

    def _word(self, word: str) -> tuple[list[int], str]:
        def shape(m: re.Match) -> str:
            run = m.group()
            return "A" if run.isupper() and len(run) > 1 else "a"

        if len(self.known) > self.most:
            self.known.clear()
        bare = _OUTER.sub("", word).lower()
        slots = [_slot("w:" + bare), *(_slot(f"p:{bare[:n]}") for n in STEMS if len(bare) > n)] if bare else []
        if self.place is not None:
            slots = [self.place[s] for s in slots if s in self.place]
        found = self.known[word] = (slots, re.sub(r"\d+", "0", _LETTERS.sub(shape, word)))
        return found

    def features(self, text: str | None) -> np.ndarray:
        counts = Counter((text or "").split())
        total = sum(counts.values())
        known, slots, shapes = self.known, set(), Counter()
        for word, n in counts.items():
            own, shape = known.get(word) or self._word(word)
            slots.update(own)
            shapes[shape] += n
        whole = [_slot(f"s:{shape}:{int(3 * n / total)}") for shape, n in shapes.items()]
        whole.append(_slot("none") if not total else _slot(f"v:{min(5, int(-math.log2(len(counts) / total)))}"))
        slots.update(whole if self.place is None else (self.place[s] for s in whole if s in self.place))
        return np.fromiter(sorted(slots), dtype=np.int32, count=len(slots))


def _gradient(model_score: float, thresholds: np.ndarray, grade: int) -> tuple[float, np.ndarray]:
    """Derivatives of -log P(grade) by the score and the thresholds."""
    low = 1.0 if grade == 0 else 1 / (1 + math.exp(min(50.0, thresholds[grade - 1] - model_score)))
    high = 0.0 if grade == len(thresholds) else 1 / (1 + math.exp(min(50.0, thresholds[grade] - model_score)))
    p = max(low - high, 1e-9)
    by_low, by_high = low * (1 - low) / p, high * (1 - high) / p
    by_threshold = np.zeros(len(thresholds))
    if grade > 0:
        by_threshold[grade - 1] += by_low
    if grade < len(thresholds):
        by_threshold[grade] -= by_high
    return by_high - by_low, by_threshold


def shares(counts: list[int], sample: int = SAMPLE) -> list[float]:
    """The share of each grade's ratings to take: equal numbers of each, what one grade lacks going to the others."""
    taken, left = [0.0] * len(counts), float(sample)
    for done, k in enumerate(sorted(range(len(counts)), key=lambda k: counts[k])):
        taken[k] = min(counts[k], left / (len(counts) - done))
        left -= taken[k]
    return [t / c if c else 1.0 for t, c in zip(taken, counts)]


def _pass_over(rows: list[tuple[int, np.ndarray]], model: Model, stands_for: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and thresholds after ``PASSES`` adaptive passes over the rows, and which weights were touched; a row of grade k
    counts ``stands_for[k]`` times."""
    w, t = model.weights.copy(), model.thresholds.copy()
    seen = np.full(len(w), 1e-2)
    t_seen = 1.0
    touched = np.zeros(len(w), dtype=bool)
    for _ in range(PASSES):
        for grade, slots in rows:
            by_score, by_threshold = (stands_for[grade] * g for g in _gradient(float(w[slots].sum()), t, grade))
            seen[slots] += by_score * by_score
            step = RATE / np.sqrt(seen[slots])
            moved = w[slots] - step * by_score
            w[slots] = np.sign(moved) * np.maximum(np.abs(moved) - step * SHRINK, 0)  # words that say nothing end at zero
            t_seen += float(by_threshold @ by_threshold)
            t = np.sort(t - RATE * by_threshold / math.sqrt(t_seen))
            touched[slots] = True
    return w, t, touched


def fit(docs: DataFrame, ratings: DataFrame, grades: int, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from ``ratings`` (``doc_id``, ``grade`` from 0 to ``grades - 1``) of ``docs``."""
    thresholds = np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(grades - 1)
    rated = ratings.select(F.col("doc_id").alias("node"), "grade").filter(F.col("node").isNotNull() & F.col("grade").between(0, grades - 1))
    counted = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    counts = [counted.get(k, 0) for k in range(grades)]
    share = shares(counts, sample)
    mean = sum(c * s for c, s in zip(counts, share)) / max(1, sum(counts))
    stands_for = [mean / s for s in share]
    hashed = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    chosen = rated.filter(hashed < F.get(F.array(*[F.lit(int(s * (1 << 30))) for s in share]), F.col("grade").cast("int")))
    picked = possible_rows(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), chosen.select("node"))
    joined = picked.join(chosen, F.col("doc_id") == F.col("node")).select("doc_id", "grade", "text")

    def featurize(batches):
        featurizer = Featurizer()
        for batch in batches:
            slots = [featurizer.features(v.as_py()) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("grade").cast(pa.int32()), pa.array(slots, pa.list_(pa.int32()))], ["doc_id", "grade", "slots"])

    examples = joined.mapInArrow(featurize, "doc_id long, grade int, slots array<int>")
    # a shard stays in one partition of the checkpoint, so that the rounds below need no shuffle
    examples = checkpointed(examples.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS))).repartition(SHARDS, "shard"))
    # features of few rated documents would only be learned by heart; how many are left depends on the sample alone, and a larger sample leaves more
    frequent = examples.select(F.explode("slots").alias("slot")).groupBy("slot").count().filter(F.col("count") >= LEAST).select("slot")
    slots = np.array(sorted(r["slot"] for r in frequent.collect()), dtype=np.int64)
    model = Model(slots, np.zeros(len(slots)), thresholds)
    examples_schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("slots", pa.list_(pa.int32())), ("shard", pa.int64())])
    for _ in range(ROUNDS):
        current = model

        def shard(rows: pa.Table) -> pa.Table:
            lists = rows.column("slots").combine_chunks()
            flat, ends = np.asarray(lists.values), np.asarray(lists.offsets)
            ids, given = rows.column("doc_id").to_numpy(), rows.column("grade").to_numpy()
            places = np.minimum(np.searchsorted(current.slots, flat), max(0, len(current.slots) - 1))
            known = current.slots[places] == flat if len(current.slots) else np.zeros(len(flat), dtype=bool)
            examples_of = [(int(given[k]), places[ends[k] : ends[k + 1]][known[ends[k] : ends[k + 1]]]) for k in np.lexsort((given, ids))]
            order = np.random.default_rng(1).permutation(len(examples_of))
            w, t, touched = _pass_over([examples_of[k] for k in order], current, stands_for)
            return pa.table({"w": [w[touched].astype(np.float32).tobytes()], "at": [np.flatnonzero(touched).astype(np.int32).tobytes()], "t": [t.tobytes()]})

        def shards(batches):
            rows = pa.Table.from_batches([b.cast(examples_schema) for b in batches], examples_schema)
            for k in sorted(set(rows.column("shard").to_pylist())):
                yield from shard(rows.filter(pc.equal(rows.column("shard"), k))).to_batches()

        parts = examples.mapInArrow(shards, "w binary, at binary, t binary").collect()  # one row per shard
        if not parts:
            break
        total, count, thresholds = np.zeros(len(slots)), np.zeros(len(slots)), np.zeros(grades - 1)
        for part in sorted(parts, key=lambda p: bytes(p["t"])):
            at = np.frombuffer(part["at"], dtype=np.int32)
            total[at] += np.frombuffer(part["w"], dtype=np.float32) - model.weights[at]
            count[at] += 1
            thresholds += np.frombuffer(part["t"]) / len(parts)
        model = Model(slots, model.weights + total / np.maximum(count, 1), thresholds)
    return model


def score(df: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``expected_grade`` and ``tails``, P(grade >= k) for k = 1, 2, ..."""
    compact = Model(model.slots, model.weights.astype(np.float32), model.thresholds)

    def run(batches):
        featurizer = Featurizer(compact.slots)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tails = [compact.tails(float(compact.weights[featurizer.features(v.as_py())].sum(dtype=np.float64))) for v in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([sum(t) for t in tails], pa.float64()), pa.array(tails, pa.list_(pa.float64()))], ["doc_id", "expected_grade", "tails"])

    picked = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, expected_grade double, tails array<double>")
