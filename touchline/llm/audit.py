"""Filter interaction audit with a counting-Bloom duplicate prepass (operator 13).

Five filters fail documents independently of each other: A few words, B few distinct words, C many capitals, D special
characters, E the whole text is that of a document with a smaller id. What an order of filters removes, finds already removed and
loses is then a sum over counts per failure mask.

**Prepass.** Every text adds one to ``PROBES`` counters of a counting Bloom sketch. A sketch is a table (slot, count): each task's
partial sums are its own sketch, the shuffle adds them up. A text with any counter below two is the only one of its kind and is
cleared; the slots counted twice or more form a bitmap of at most ``MOST_SLOTS`` bits (128 MiB) that all tasks get.
``slots`` follows the number of rows up to that bound; a table with far more rows clears fewer texts and shuffles more, with
the same result.

**Exact step.** Only possible repeats keep their text; these are grouped by the full text for its least id, combined before the
shuffle, so a text that a third of the documents share costs one row per task. The ids found decide filter E for single
documents by (id, digest).

**Counts.** Documents are counted by (part, failure mask, labels); orders and steps are expanded over these counts only.

Hard rows: a null text is the empty text, which is a text like others; a null part is the empty string; a document without id is
not larger than any other and never fails E, nor has it labels; rows that repeat an id with one text are all first; a label is set
if any row of its id sets it. Texts are measured whole whatever their length. An empty table has no parts and gives no rows.
Columns besides those named are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shared_folder

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
PROBES = 3
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 30
_CAPITALS = bytes(range(65, 91))
_INNER_BYTES = bytes(range(0x80, 0xC0))
_SPECIAL = re.compile(rb"[#$%&*|]")


def text_mask(raw: bytes) -> int:
    """The bits of the filters A to D that the text (UTF-8) fails."""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    points = len(raw.translate(None, _INNER_BYTES))
    failed = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * points, _SPECIAL.search(raw) is not None)
    return sum(bit << k for k, bit in enumerate(failed))


def _probes(text: Column, slots: int) -> list[Column]:
    seed = F.xxhash64(text)
    return [F.pmod(F.xxhash64(seed, F.lit(k)), F.lit(slots)).cast("bigint") for k in range(PROBES)]


def repeat_slots(texts: DataFrame, text: str, slots: int) -> bytes:
    """The merged sketch of all texts as a bitmap: a bit for every slot whose counter is two or more."""
    probes = texts.select(F.explode(F.array(*_probes(F.col(f"`{text}`"), slots))).alias("slot"))
    twice = probes.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select((F.col("slot") + 1).alias("value"))
    maps = twice.groupBy(F.bitmap_bucket_number("value").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits"))
    out = bytearray(slots // 8)
    for row in maps.toLocalIterator():
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] = bytes(row.bits)
    return bytes(out)


def _measure(bitmap: bytes):
    """Rows (doc_id, part, mask, text): the text stays only where it may be repeated."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for batch in batches:
            possible = np.ones(batch.num_rows, bool)
            for k in range(PROBES):
                slot = batch.column(f"slot{k}").to_numpy(zero_copy_only=False)
                possible &= (bits[slot >> 3] >> (slot & 7) & 1).astype(bool)
            texts = batch.column("text")
            masks = pa.array([text_mask(t.as_py()) for t in texts], pa.int32())
            kept = pa.array([t.as_py() if p else None for t, p in zip(texts, possible)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), masks, kept], schema=schema)

    return run


def failures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source", slots: int | None = None) -> DataFrame:
    """``doc_id``, ``part``, failure ``mask`` and the number ``n`` of such documents (more than one only for repeated or null ids)."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    if slots is None:
        slots = min(max(1 << (16 * source.count()).bit_length(), LEAST_SLOTS), MOST_SLOTS)
    bitmap = repeat_slots(source, "text", slots)
    probed = source.withColumns({f"slot{k}": p for k, p in enumerate(_probes(F.col("text"), slots))}).withColumn("text", F.col("text").cast("binary"))
    path = shared_folder(spark, "audit")
    probed.mapInArrow(_measure(bitmap), "doc_id bigint, part string, mask int, text binary").write.parquet(path)
    marks = spark.read.schema("doc_id bigint, part string, mask int, text binary").parquet(path)
    digest = F.sha2("text", 256)
    known = F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    firsts = marks.filter(known).groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", digest.alias("digest"), F.lit(True).alias("first"))
    rows = marks.select("doc_id", "part", "mask", F.when(known, digest).alias("digest")).groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    judged = rows.join(firsts, ["doc_id", "digest"], "left")
    repeated = F.col("digest").isNotNull() & F.col("first").isNull()
    return judged.select("doc_id", "part", F.when(repeated, F.col("mask").bitwiseOR(DUPLICATE)).otherwise(F.col("mask")).alias("mask"), "n")


def mask_counts(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents per ``part``, ``mask``, ``good`` (label quality is 1) and ``toxic`` (label toxic is 1)."""
    known = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("bigint").alias("doc_id"))
    rated = known.agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return failed.join(rated, "doc_id", "left").groupBy("part", "mask", flag("good"), flag("toxic")).agg(F.sum("n").alias("n"))


def interactions(counts: DataFrame) -> DataFrame:
    """For every part, order of the filters and step what the step's filter keeps, removes and finds already removed."""
    cell = F.struct(F.col("mask").cast("int").alias("mask"), "good", "toxic", "n")
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.groupBy("part").agg(F.collect_list(cell).alias("cells"))
    steps = steps.select("part", "cells", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda k: f"shiftleft(1, instr('{FILTERS}', substr(filter_order, {k}, 1)) - 1)"
    steps = steps.withColumns({
        "bit": F.expr(bit("step")), "earlier": F.expr(f"aggregate(sequence(1, {len(FILTERS)}), 0, (a, k) -> a | if(k < step, {bit('k')}, 0))")})
    count = lambda condition: F.expr(f"aggregate(filter(cells, c -> {condition}), 0L, (a, c) -> a + c.n)")
    here = "(c.mask & bit) != 0 AND (c.mask & earlier) = 0"
    share = "aggregate(filter(cells, c -> (c.mask & bit) != 0), 0L, (a, c) -> a + c.n * cast(120 div bit_count(c.mask) as bigint))"
    return steps.select(
        "part", "filter_order", "step", count("(c.mask & (earlier | bit)) = 0").alias("kept"), count(here).alias("removed"),
        count("(c.mask & bit) != 0 AND (c.mask & earlier) != 0").alias("redundant"), count("c.mask = bit").alias("unique_fails"),
        count(f"{here} AND c.good").alias("good_lost"), count(f"{here} AND c.toxic").alias("toxic_lost"), F.expr(share).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, slots: int | None = None) -> DataFrame:
    """The whole audit of ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic)."""
    return interactions(mask_counts(failures(docs, slots=slots), labels))
