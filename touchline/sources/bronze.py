"""Bronze document table: idempotent append and profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators.joins import without
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key
from touchline.sources.files import (
    discover_files, mark_ingested, pending_files, read_pending, short_paths, split_documents, tag_documents,
)

KEY = ["source", "entity_type", "content_hash"]
BRONZE_COLUMNS = [
    "source", "entity_type", "entity_id", "payload", "source_url", "content_hash", "ingestion_time", "season", "league",
]
#: Bronze is partitioned by source, entity type and the first hexadecimal digits of the content hash: a key lies in one bucket.
BUCKET_DIGITS = 2
PLACE = ["source", "entity_type", "bucket"]
#: Bits of a bucket's filter; beyond about as many keys in a bucket the filter clears few and the exact look-up does the work.
FILTER_BITS = 1 << 20


def new_records(records: DataFrame, bronze: DataFrame | None) -> DataFrame:
    """One record per key of the batch that ``bronze`` does not hold yet; reads the key columns of all of ``bronze``.

    ``insert_new`` does the same on a stored table and reads the buckets concerned only.
    """
    once = latest_per_key(records, KEY, [F.col("rel_path").asc()])
    return once if bronze is None else without(once, bronze, KEY)


def _bucket() -> Column:
    return F.substring("content_hash", 1, BUCKET_DIGITS)


def _slot() -> Column:
    return F.pmod(F.xxhash64("content_hash"), F.lit(FILTER_BITS))


def _in_places(rows: DataFrame) -> Column | None:
    """A condition on the partition columns alone: the buckets in which ``rows`` lie (as many at most as there are partitions)."""
    held = rows.groupBy("source", "entity_type").agg(F.collect_set("bucket").alias("buckets")).collect()
    each = [(F.col("source") == r.source) & (F.col("entity_type") == r.entity_type) & F.col("bucket").isin(r.buckets) for r in held]
    return reduce(lambda a, b: a | b, each) if each else None


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path)


def _filters_path(path: str) -> str:
    return f"{path.rstrip('/')}_filters"


def unseen(once: DataFrame, path: str) -> DataFrame:
    """Rows of ``once`` (distinct keys, with ``bucket``) that the table at ``path`` does not hold.

    Each bucket has a bitmap of the keys in it. Keys whose bit is not set are new without a look at the table; for the others
    the keys of their buckets are read and compared exactly. Untouched partitions are neither listed in the scan nor read.
    """
    spark = once.sparkSession
    filters = _stored(spark, _filters_path(path), "source STRING, entity_type STRING, bucket STRING, part BIGINT, bits BINARY")
    touched = None if filters is None else _in_places(once)
    if touched is None:
        return once
    bitmaps = filters.filter(touched).groupBy(*PLACE, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = once.withColumns({"part": F.bitmap_bucket_number(_slot()), "_bit": F.bitmap_bit_position(_slot())})
    octet = F.conv(F.hex(F.substring("bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", octet, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    tried = cut_lineage(
        asked.join(bitmaps, [*PLACE, "part"], "left").select(*KEY, "bucket", F.coalesce(held, F.lit(False)).alias("maybe")))
    doubtful = tried.filter("maybe")
    where = _in_places(doubtful)
    if where is None:
        return once
    keys = _stored(spark, path, f"{schemas.BRONZE}, bucket STRING").filter(where).select(*KEY)
    return without(once, cut_lineage(doubtful.select(*KEY).join(keys, KEY, "left_semi")), KEY)


def insert_new(records: DataFrame, path: str, now: Column | None = None) -> int:
    """Append what bronze does not hold yet; returns the number of rows inserted.

    The filters learn the new keys before the table does: after a crash between the two they only know too much, and a
    repeated run still finds the missing rows.
    """
    once = cut_lineage(latest_per_key(records, KEY, [F.col("rel_path").asc()]).withColumn("bucket", _bucket()))
    fresh = unseen(once, path)
    placed = fresh.select(*PLACE, F.bitmap_bucket_number(_slot()).alias("part"), F.bitmap_bit_position(_slot()).alias("_bit"))
    bits = placed.groupBy(*PLACE, "part").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    bits.repartition(*PLACE).write.mode("append").partitionBy(*PLACE).parquet(_filters_path(path))
    return append_bronze(as_bronze(fresh, now), path)


def as_bronze(records: DataFrame, now=None) -> DataFrame:
    """Records in the bronze layout, stamped with the load time."""
    return records.select(
        "source", "entity_type", F.lit(None).cast("string").alias("entity_id"), "payload",
        F.lit(None).cast("string").alias("source_url"), "content_hash",
        (now if now is not None else F.current_timestamp()).alias("ingestion_time"), "season", "league",
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table; empty before the first load."""
    stored = _stored(spark, path, f"{schemas.BRONZE}, bucket STRING")
    return spark.createDataFrame([], schemas.BRONZE) if stored is None else stored.drop("bucket")


def append_bronze(df: DataFrame, path: str) -> int:
    """Append, partitioned so that every staging model prunes to its own documents; returns the rows written."""
    written = Observation()
    # one writer per partition, so that a batch adds one file to each bucket it touches
    dealt = df.withColumn("bucket", _bucket()).repartition(*PLACE)
    dealt.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(*PLACE).parquet(path)
    return written.get["n"]


def outcome_counts(good: DataFrame, bad: DataFrame, inserted: int) -> DataFrame:
    """Inserted / skipped / failed in one row."""
    one = good.agg(F.count(F.lit(1)).alias("read")).crossJoin(F.broadcast(bad.agg(F.count(F.lit(1)).alias("failed"))))
    done = F.lit(inserted).cast("bigint")
    return one.select(done.alias("inserted"), (F.col("read") - done).alias("skipped"), "failed")


def ingest(
    spark: SparkSession, root: str, bronze_path: str, tracked: DataFrame,
    source: str | None = None, date: str | None = None, full_rehash: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load changed files; returns (tracking table, quarantine with short paths, outcome counts).

    The hashed batch is materialised once, so each file is opened once per run, and appended once, the
    inserted rows counted on the way. Tracking only advances for files whose record is in bronze.
    """
    files, short = discover_files(spark, root, source, date)
    docs = read_pending(pending_files(files, tracked, full_rehash))
    good, bad = split_documents(cut_lineage(tag_documents(docs)))
    inserted = insert_new(good, bronze_path)
    counted = outcome_counts(good, bad, inserted)
    return cut_lineage(mark_ingested(tracked, good)), bad.unionByName(short_paths(short)), counted


def profile(bronze: DataFrame) -> DataFrame:
    """Documents per source and entity type."""
    return bronze.groupBy("source", "entity_type").agg(F.count(F.lit(1)).alias("n")).orderBy("source", "entity_type")
