"""Ranked lexical search by the Best Position Algorithm (operator 12).

**Statistics.** One pass over the documents keeps, per document, its length and the counts of the terms that may occur in some
query (a bitmap of fixed size tells); document counts per term and corpus totals are pre-aggregated sums over it.

**Ranking.** Documents stay where they are. A task cuts its stream into segments of about ``SEGMENT_DOCS`` documents or
``SEGMENT_POSTINGS`` postings, and builds for each segment one *impact list* per query term (documents by falling contribution)
and the same contributions by document. A query reads its lists from their tops; every document that turns up is scored at once
by direct access to its contributions in all the query's lists, and counts as *seen* in all of them. The best position of a list
is the last one up to which every document has been seen, whichever list it was met in; the sum of the contributions at the best
positions bounds every unseen document. A query stops as soon as this bound lies strictly below its k-th score, so documents with
an equal score are never missed; the k best carry over from segment to segment, which makes later segments stop sooner. The
best of all tasks are ranked at the end: a task sends k rows per query whatever its number of documents, and no term's list is
ever gathered, so a term that every document holds is as cheap as any.

Queries go out in blocks of about ``BLOCK_TERMS`` terms, each block one pass over the table of counts.

Hard rows: null and empty texts hold no term and are in no result; a query without terms has no rows; queries of one id are one
query with the terms of all its rows; rows that repeat a document id are ranked each on its own, null ids after all others with
the same score. Ids of documents are integers. Very long texts are counted whole. Empty tables give no rows. Columns besides
those named are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import shared_folder

SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 15, 1 << 22
BLOCK_TERMS = 200_000
BITS = 1 << 23
#: Positions read from every list in a query's first round; doubled each round.
FIRST_STEP, LAST_STEP = 16, 4096
_NO_ID = np.iinfo(np.int64).max
_KNOWN_TERMS = 1 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of digits, ASCII letters (lower-cased) and everything outside ASCII, in order."""
    return (text or b"").translate(_FOLD).split()


def _slot(term: bytes) -> int:
    return zlib.crc32(term) & (BITS - 1)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        slots = [[_slot(t) for t in ts] for ts in found]
        texts = pa.array([[t.decode() for t in ts] for ts in found], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("item"), texts, pa.array(slots, pa.list_(pa.int32()))], names=["item", "terms", "slots"])


def _counts(bitmap: bytes):
    """Per document: length in terms and the counts of terms whose bit is set."""
    bits = np.frombuffer(bitmap, np.uint8)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, str | None] = {}
        for batch in batches:
            lengths, kept, tfs = [], [], []
            for text in batch.column("text"):
                found = terms(text.as_py())
                names, counts = [], []
                for term, count in Counter(found).items():
                    if term not in known:
                        if len(known) >= _KNOWN_TERMS:
                            known.clear()
                        slot = _slot(term)
                        known[term] = term.decode() if bits[slot >> 3] >> (slot & 7) & 1 else None
                    if (name := known[term]) is not None:
                        names.append(name)
                        counts.append(count)
                lengths.append(len(found))
                kept.append(names)
                tfs.append(counts)
            columns = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip((lengths, kept, tfs), schema.types[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _bitmap(slots: DataFrame) -> bytes:
    """All slots as one bitmap of ``BITS`` bits."""
    value = F.col("slot").cast("bigint") + 1
    rows = slots.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")).collect()
    out = bytearray(BITS // 8)
    for row in rows:
        # bucket 1 holds slots 0 to 32767
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = bytes(row.bits)
    return bytes(out)


@dataclass(frozen=True)
class Block:
    """Queries to be ranked in one pass: terms with their weights, and the term numbers of each query."""

    terms: dict[str, int]
    weights: np.ndarray
    queries: list[np.ndarray]
    documents: int
    length: int
    k: int
    segment_docs: int = SEGMENT_DOCS


class Segment:
    """Impact lists of some documents, and the same impacts by document."""

    def __init__(self, block: Block, ids: np.ndarray, lengths: list[int], starts: np.ndarray, term: np.ndarray, tf: np.ndarray):
        doc = np.repeat(np.arange(len(ids)), np.diff(starts))
        held = term >= 0
        doc, term, tf = doc[held], term[held], tf[held].astype(np.int64)
        m = np.array([10 + 90 * n * block.documents // block.length for n in lengths], np.int64)
        impact = block.weights[term] * ((10**9 * tf) // (1000 * tf + 8 * m[doc]))
        held = impact > 0
        self.ids, self.doc, self.term, self.impact = ids, doc[held], term[held], impact[held]
        self.row = np.searchsorted(self.doc, np.arange(len(ids) + 1))
        order = np.lexsort((-self.impact, self.term))
        self.list_doc, self.list_impact = self.doc[order], self.impact[order]
        cuts = np.searchsorted(self.term[order], np.arange(len(block.weights) + 1))
        self.start, self.size = cuts[:-1], np.diff(cuts)
        self.seen = np.zeros(len(ids), bool)
        self.asked = np.zeros(len(block.weights), bool)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Direct access: what the asked terms give each document (every one holds some)."""
        sizes = self.row[docs + 1] - self.row[docs]
        firsts = np.cumsum(sizes) - sizes
        at = np.repeat(self.row[docs] - firsts, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(np.where(self.asked[self.term[at]], self.impact[at], 0), firsts)

    def best(self, query: np.ndarray, k: int, top: tuple[np.ndarray, np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], int]:
        """The ``k`` best of ``top`` (scores, ids) and this segment's documents, and the number of documents scored."""
        lists = query[self.size[query] > 0]
        start, size = self.start[lists], self.size[lists]
        position = np.zeros(len(lists), np.int64)
        self.asked[lists] = True
        met, step = [], FIRST_STEP
        while len(lists):
            # sorted access to the next positions of every list; what is new is scored by direct access
            read = position[:, None] + np.arange(step)
            docs = self.list_doc[(start[:, None] + read)[read < size[:, None]]]
            new = np.unique(docs[~self.seen[docs]])
            if len(new):
                self.seen[new] = True
                met.append(new)
                top = _merged(top, self.scores(new), self.ids[new], k)
            position = self._best_positions(start, size, np.minimum(position + step, size))
            more = position < size
            bound = self.list_impact[(start + position - 1)[more]].sum()
            if bound < (top[0][-1] if len(top[0]) == k else 1):
                break
            lists, start, size, position = lists[more], start[more], size[more], position[more]
            step = min(2 * step, LAST_STEP)
        self.asked[query] = False
        for docs in met:
            self.seen[docs] = False
        return top, sum(map(len, met))

    def _best_positions(self, start: np.ndarray, size: np.ndarray, position: np.ndarray, window: int = 32) -> np.ndarray:
        """Each list's best position: moved on over documents already seen through other lists."""
        position, moving = position.copy(), np.flatnonzero(position < size)
        while len(moving):
            ahead = position[moving, None] + np.arange(window)
            inside = ahead < size[moving, None]
            at = np.where(inside, start[moving, None] + ahead, 0)
            run = inside & self.seen[self.list_doc[at]]
            steps = np.where(run.all(axis=1), window, run.argmin(axis=1))
            position[moving] += steps
            moving = moving[(steps == window) & (position[moving] < size[moving])]
        return position


def _merged(top: tuple[np.ndarray, np.ndarray], scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    floor = top[0][-1] if len(top[0]) == k else 1
    good = scores >= floor
    scores, ids = np.concatenate([top[0], scores[good]]), np.concatenate([top[1], ids[good]])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _rank(block: Block):
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("scored", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        tops = [(none, none)] * len(block.queries)
        scored = [0] * len(block.queries)
        ids, lengths, sizes, numbers, tfs = [], [], [], [], []
        held = [0, 0]

        def close() -> None:
            starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            segment = Segment(block, np.concatenate(ids), lengths, starts, np.concatenate(numbers), np.concatenate(tfs))
            for q, query in enumerate(block.queries):
                tops[q], count = segment.best(query, block.k, tops[q])
                scored[q] += count
            for kept in (ids, lengths, sizes, numbers, tfs):
                kept.clear()
            held[:] = [0, 0]

        for batch in batches:
            names = batch.column("terms")
            flat = names.flatten().dictionary_encode()
            number = np.array([block.terms.get(t, -1) for t in flat.dictionary.to_pylist()] or [-1], np.int64)
            ids.append(batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False))
            lengths += batch.column("n").to_pylist()
            sizes.append(names.value_lengths().to_numpy(zero_copy_only=False))
            numbers.append(number[flat.indices.to_numpy(zero_copy_only=False)])
            tfs.append(batch.column("tfs").flatten().to_numpy(zero_copy_only=False))
            held[0] += batch.num_rows
            held[1] += len(flat)
            if held[0] >= block.segment_docs or held[1] >= SEGMENT_POSTINGS:
                close()
        if held[0]:
            close()
        for q, (scores, found) in enumerate(tops):
            if len(scores):
                n = len(scores)
                docs = pa.array(found, pa.int64(), mask=found == _NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array([q] * n, pa.int32()), docs, pa.array(scores), pa.array([scored[q]] * n, pa.int64())], schema=schema)

    return run


def _blocks(asked: DataFrame, documents: int, length: int, k: int, segment_docs: int, block_terms: int):
    """Blocks of queries with the ids of their queries; ``asked`` holds item, term and the term's document count ``df``."""
    total = asked.count()
    parts = max(1, math.ceil(total / block_terms))
    part = F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(parts))
    for p in range(parts):
        grouped = asked.filter(part == p).groupBy("item").agg(F.collect_list(F.struct("term", "df")).alias("terms")).collect()
        names = {}
        queries = [np.array(sorted(names.setdefault(t.term, (len(names), t.df))[0] for t in row.terms), np.int64) for row in grouped]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for _, df in names.values()], np.int64)
        if queries:
            yield [row.item for row in grouped], Block({t: n for t, (n, _) in names.items()}, weights, queries, documents, length, k, segment_docs)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    segment_docs: int = SEGMENT_DOCS, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents per query, and how many ``scored`` documents its tasks met.

    A term weighs floor(1000 ln((2N+2)/(2df+1))); its contribution is that times (1e9 tf) div (1000 tf + 8 m) with the document's
    m = 10 + (90 n N) div L, in 64-bit integers.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "lexical")
    wanted = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    kind = wanted.schema["item"].dataType.simpleString()
    wanted.mapInArrow(_query_terms, f"item {kind}, terms array<string>, slots array<int>").write.parquet(f"{folder}/queries")
    queries = spark.read.parquet(f"{folder}/queries")
    bitmap = _bitmap(queries.select(F.explode("slots").alias("slot")))
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    source.mapInArrow(_counts(bitmap), "doc_id bigint, n bigint, terms array<string>, tfs array<int>").write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    totals = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    pairs = queries.select("item", F.explode("terms").alias("term")).distinct()
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    pairs.join(found, "term").write.parquet(f"{folder}/asked")
    asked = spark.read.parquet(f"{folder}/asked")
    rows = counts.filter(F.size("terms") > 0)
    ranked = []
    for ids, block in _blocks(asked, totals.documents, totals.length, k, segment_docs, block_terms):
        names = spark.createDataFrame(list(enumerate(ids)), f"query int, item {kind}")
        each = rows.mapInArrow(_rank(block), "query int, doc_id bigint, score bigint, scored bigint")
        ranked.append(each.join(names, "query").select("item", "doc_id", "score", "scored"))
    if not ranked:
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, doc_id bigint, score bigint, scored bigint")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    placed = reduce(DataFrame.unionByName, ranked).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return placed.select(F.col("item").alias(item_id), "rank", "doc_id", "score", "scored")
