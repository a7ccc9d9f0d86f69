"""What the text operators share: tables, word arrays, bindings inside expressions and checkpoints."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"
#: Bits of the bitmap that says which rows may be needed (1 MiB whatever the input).
BITMAP_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of ``text`` in order; null for a null text."""
    return F.array_remove(F.split(text, WHITE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it.

    Inside a lambda an ordinary column expression would be evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame) -> DataFrame:
    """Every row as one struct ``row``, so that helper columns cannot clash with the caller's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that lost executors cost no recomputation.

    The folder is the session's ``spark.checkpoint.dir``; a temporary one is taken only on a single machine where none is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go: Spark deletes them once the driver has collected the plans that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sums_before(lengths: Column, block: int = 64) -> Column:
    """For each element of an int array the sum of all earlier ones, by block sums (no array is copied per element)."""
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(lengths) - 1) / block).cast("int")), lambda b: total(F.slice(lengths, b * block + 1, block)))

    def with_blocks(per_block: Column) -> Column:
        heads = F.transform(per_block, lambda _, b: total(F.slice(per_block, F.lit(1), b)))
        place = lambda heads: F.transform(
            lengths, lambda _, i: F.get(heads, (i / block).cast("int")) + total(F.slice(lengths, (i / block).cast("int") * block + 1, i % block)))
        return let(heads, place)

    return let(blocks, with_blocks)


def spans(pieces: Column, found: Column) -> Column:
    """Structs ``start``, ``stop``, ``value`` (in code points) of matches ``found`` between the ``pieces`` of a split text."""
    steps = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))

    def build(before: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(pieces, i))
            return F.struct(start.alias("start"), (start + F.length(m)).alias("stop"), m.alias("value"))

        return F.transform(found, span)

    return let(let(steps, lambda s: sums_before(s)), build)  # noqa: PLW0108 (a second parameter would be the index)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (never empty ones): structs ``start``, ``stop`` in code points, ``value``.

    The pieces between the matches and the matches themselves add up to the offsets.
    """
    return matches_of(text, F.lit(pattern))


def matches_of(text: Column, pattern: Column) -> Column:
    """``matches`` of a pattern that is a column itself."""
    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    placed = lambda found: let(F.split(text, pattern, F.lit(-1)), lambda pieces: spans(pieces, found))
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def may_hold(df: DataFrame, value: Column, known: DataFrame, known_value: Column, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """``df`` with the boolean ``name``: false only where ``value`` (a 64-bit hash) is surely not among ``known_value`` of ``known``.

    A bitmap of ``bits`` bits is broadcast, whatever the number of rows; the more there are, the more rows stay possible.
    """
    slot = F.pmod(known_value, F.lit(bits))
    placed = known.select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit"))
    maps = placed.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    at = F.pmod(value, F.lit(bits))
    bit = F.bitmap_bit_position(at)
    octet = F.conv(F.hex(F.substring("_bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", octet, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = df.join(F.broadcast(maps), F.bitmap_bucket_number(at) == F.col("_bucket"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(held, F.lit(False)).alias(name))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder; a temporary folder only on a single machine without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def possible_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``doc_id`` is not among ``ids.node``: a bitmap of fixed size is broadcast."""
    slot = F.pmod(F.xxhash64("node"), F.lit(BITMAP_BITS))
    bits = ids.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    maps = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS))
    tried = docs.withColumn("bucket_of", F.bitmap_bucket_number(at)).withColumn("bit_of", F.bitmap_bit_position(at))
    octet = F.conv(F.hex(F.substring("bitmap", (F.col("bit_of") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("cast(bit_of % 8 as int)")
    joined = tried.join(F.broadcast(maps), F.col("bucket_of") == F.col("bucket"))
    return joined.filter(F.call_function("shiftright", octet, bit).bitwiseAND(F.lit(1)) == 1).select(*docs.columns)
