"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a keyed random order, repeated up to ``MAX_COPIES`` times. A copy's virtual finish
time is the source's cumulative size up to its end divided by the source's target, so sources advance in step with their
targets. All copies are put into order of finish time and the mix is the prefix whose sizes fit the total budget.

Both running sums (within a source, and over the mix) use fixed range slices: sums per slice, then a running sum over the
slices. The slices of a source are ranges of a uniform hash, so a source that holds a third of all rows is spread over all of
them; the hash is of id and text, so rows without id are spread like others. The slices of the mix are ranges of virtual time; the
slice in which the budget ends is sliced again until few copies are left to be ordered one by one. Only ids, hashes and sizes are
shuffled, never texts. Work on one task: one row per source (sources are taken to be far fewer than documents), one row per slice
of virtual time, and ``CUT_ROWS`` copies.

Null texts have size 0; a null source is a source of its own, last in order. Documents of size 0 take 0 words. Rows that repeat
id, source and text are taken equally often. An empty table gives an empty mix. Reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, packed, words

#: Weights by place of the source in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often, so no target exceeds this multiple of its source.
MAX_COPIES = 3
#: Slices of virtual time per unit; the budget falls near time 1.
TIME_SLICES = 4096
#: Copies of the stretch in which the budget ends that one task orders; a longer stretch is sliced again.
CUT_ROWS = 100_000
SEED = "mix-1"


def sizes(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per different (id, source, text): ``size`` in words, ``rows`` that repeat it, and the key of the random order."""
    ident = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    content = F.col(f"`{text}`")
    return (
        df.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            F.coalesce(F.size(words(content)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(content).alias("content"),
            F.md5(F.concat(ident, F.lit(f":{SEED}:"), F.md5(F.coalesce(content, F.lit("")).cast("binary"))).cast("binary")).alias("shuffled"),
        )
        .groupBy("doc_id", "source", "size", "content", "shuffled")
        .agg(F.count("*").alias("rows"))
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: ``source_size``, ``weight`` and ``target``.

    The targets share the total size by weight. Sources whose share exceeds ``max_copies`` times their size stop there and
    the rest is shared anew. Ordered by size per weight, the stopped sources are a prefix, so one pass finds the final level.
    """
    by_source = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    named = F.col("source").asc_nulls_last()
    place = (F.row_number().over(W.orderBy(named)) - 1) % len(weights)
    weighed = by_source.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place).cast("long"))
    order = W.orderBy(F.col("source_size") / F.col("weight"), named)
    before, so_far, everything = (order.rowsBetween(W.unboundedPreceding, k) for k in (-1, 0, W.unboundedFollowing))
    ranked = weighed.select(
        "*",
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("stopped_size"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open_weight"),
        F.sum("source_size").over(everything).alias("total"),
    ).withColumn("left_over", F.col("total") - max_copies * F.col("stopped_size"))
    share = F.col("weight") * F.col("left_over") / F.col("open_weight")
    # the first source that its share does not overfill sets the level of all that follow it
    opened = ranked.withColumn("open", F.max(share <= max_copies * F.col("source_size")).over(so_far))
    level = lambda c: F.first(F.when(F.col("open"), F.col(c)), ignorenulls=True).over(everything)
    shared = F.col("weight") * level("left_over") / level("open_weight")
    return opened.select(
        "source", "source_size", "weight",
        F.when(F.col("open"), shared).otherwise((F.col("source_size") * max_copies).cast("double")).alias("target"),
    )


def queued(sized: DataFrame) -> DataFrame:
    """``sized`` with ``cumulative``, the source's running size in random order, its own included."""
    sliced = sized.withColumn("slice", F.substring("shuffled", 1, 3)).withColumn("load", F.col("size") * F.col("rows"))
    earlier = W.partitionBy("source_of").orderBy("slice_of").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(F.col("source").alias("source_of"), F.col("slice").alias("slice_of"))
        .agg(F.sum("load").alias("slice_load"))
        .select("source_of", "slice_of", F.coalesce(F.sum("slice_load").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = W.partitionBy("source", "slice").orderBy("shuffled", "doc_id", "content").rowsBetween(W.unboundedPreceding, 0)
    same = F.col("source").eqNullSafe(F.col("source_of")) & (F.col("slice") == F.col("slice_of"))
    return (
        sliced.join(offsets, same)
        .withColumn("cumulative", F.col("offset") + F.sum("load").over(inside))
        .drop("slice", "slice_of", "source_of", "offset")
    )


def schedule(sized: DataFrame, target: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Every copy of every document with its virtual ``finish`` time and the ``slice`` of time that it falls in."""
    t = target.select(F.col("source").alias("source_of"), "source_size", "target")
    copies = queued(sized).join(t, F.col("source").eqNullSafe(F.col("source_of"))).drop("source_of")
    served = F.col("copy") * F.col("source_size") + F.col("cumulative")
    finish = F.coalesce(served / F.expr("nullif(target, 0D)"), F.lit(0.0))
    late = 2 * TIME_SLICES + F.floor(F.log2(F.col("finish")) * 64)
    return (
        copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
        .withColumn("finish", finish)
        .withColumn("slice", F.when(F.col("finish") < 2, F.floor(F.col("finish") * TIME_SLICES)).otherwise(late))
    )


def _cut(copies: DataFrame, budget: int, most: int | None = None) -> tuple[float, float, int]:
    """The least and greatest finish time of a stretch in which the budget ends, and the load of all copies before it.

    The stretch is the slice of time in which the running load passes the budget, cut into slices again until it holds
    ``most`` copies or a single instant. The driver sees one row per slice.
    """
    most = most or CUT_ROWS
    stretch, offset = copies, 0
    while True:
        facts = [F.sum("load").alias("load"), F.min("finish").alias("low"), F.max("finish").alias("high"), F.count(F.lit(1)).alias("n")]
        found = None
        for row in sorted(stretch.groupBy("slice").agg(*facts).collect(), key=lambda r: r.low):
            if offset + row.load > budget:
                found = row
                break
            offset += row.load
        if found is None:
            return math.inf, math.inf, offset
        if found.n <= most or found.low == found.high:
            return found.low, found.high, offset
        place = F.least(F.floor((F.col("finish") - found.low) / (found.high - found.low) * TIME_SLICES), F.lit(TIME_SLICES - 1))
        stretch = copies.filter(F.col("finish").between(found.low, found.high)).withColumn("slice", place)


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, ``source``, ``size``, ``source_size``, its source's ``target``, ``copies`` and ``taken`` words.

    ``content`` and ``rows`` tell apart and count documents that share an id.
    """
    sized = checkpointed(sizes(df, text, source, doc_id))
    target = targets(sized)
    copies = schedule(sized, target)
    budget = target.agg(F.sum("source_size")).first()[0] or 0
    low, high, offset = _cut(copies, budget)
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("copy"), F.col("shuffled"), F.col("doc_id"), F.col("content")]
    running = F.lit(offset) + F.sum("load").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    unit = ["doc_id", "source", "size", "content", "rows", "source_size", "target"]
    inside = F.col("finish").between(low, high)
    whole = copies.filter(~inside).select(*unit, (F.col("finish") < low).cast("int").alias("n"))
    part = copies.filter(inside).select(*unit, (running <= budget).cast("int").alias("n"))
    counted = whole.unionByName(part).groupBy(*unit).agg(F.sum("n").alias("copies"))
    return counted.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The documents of the mix, one row per copy taken, all columns as they were."""
    chosen = mix(df, text, source, doc_id).filter("copies > 0").select(
        F.col("doc_id").alias("id_of"), F.col("source").alias("source_of"), F.col("content").alias("content_of"), "copies")
    rows = packed(df).withColumn("id", F.col(f"row.`{doc_id}`")).withColumn("src", F.col(f"row.`{source}`"))
    rows = rows.withColumn("content", F.xxhash64(F.col(f"row.`{text}`")))
    same = F.col("id").eqNullSafe(F.col("id_of")) & F.col("src").eqNullSafe(F.col("source_of")) & (F.col("content") == F.col("content_of"))
    return rows.join(chosen, same).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
