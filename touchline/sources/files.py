"""Raw snapshot tree: listing, change filter, tolerant read, raw sink."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.dates import file_league, file_season_token, normalize_season
from touchline.functions.json import canonical_hash
from touchline.operators.joins import without
from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import latest_per_key

LISTED = ["rel_path", "source", "entity_type", "date", "file_name", "mtime", "size_bytes"]


def _below(path: Column, root: str) -> Column:
    """The part of a file's path after the whole of ``root`` (a root without leading slash may lie anywhere)."""
    bare = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", root).rstrip("/")
    start = r"^(?:[A-Za-z][\w+.-]*:)?(?://[^/]*)?" if bare.startswith("/") else "^.*?/"
    return F.regexp_extract(path, rf"{start}\Q{bare}\E/(.*)$", 1)


def _glob_safe(name: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", name)


def _existing(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Patterns that match something (Spark refuses to load one that does not)."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found = []
    for pattern in patterns:
        path = hadoop.Path(pattern)
        if path.getFileSystem(conf).globStatus(path):
            found.append(pattern)
    return found


def _listing(spark: SparkSession, root: str, patterns: list[str]) -> DataFrame:
    """Files at the patterns with their change marks; the binary source with a pruned ``content`` column only lists."""
    found = _existing(spark, [f"{root.rstrip('/')}/{p}" for p in patterns])
    if not found:
        return spark.createDataFrame([], "path string, mtime timestamp, size_bytes bigint, rel_path string")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    listed = reader.load(found).select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size_bytes"))
    return listed.withColumn("rel_path", _below(F.col("path"), root))


def discover_files(
    spark: SparkSession, root: str, source: str | None = None, date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(well placed files, files at a too short path). Contents are not read.

    Source and date select folders while the tree is listed; what lies elsewhere is not visited. Short paths are reported
    whatever is selected.
    """
    source_folder, date_folder = (_glob_safe(v) if v else "*" for v in (source, date))
    parts = F.split("rel_path", "/")
    good = _listing(spark, root, [f"{source_folder}/*/{date_folder}"]).filter(F.size(parts) >= 4)
    placed = good.withColumns({"source": parts[0], "entity_type": parts[1], "date": parts[2], "file_name": F.element_at(parts, -1)})
    short = _listing(spark, root, ["*.json", "*/*.json", "*/*/*.json"])
    return placed.select("path", *LISTED), short.filter(F.size(parts) < 4).select("path", "rel_path")


def pending_files(files: DataFrame, tracked: DataFrame, full_rehash: bool = False) -> DataFrame:
    """Files never seen, or seen with another time or size."""
    if full_rehash:
        return files
    return without(files, tracked, {"rel_path": "file_path", "mtime": "mtime", "size_bytes": "size_bytes"})


def mark_ingested(tracked: DataFrame, done: DataFrame, now: Column | None = None) -> DataFrame:
    """S3: the tracking table after ``done`` was written, newest entry per path."""
    fresh = done.select(
        F.col("rel_path").alias("file_path"), "source", "entity_type", "mtime", "size_bytes",
        (now if now is not None else F.current_timestamp()).alias("ingested_at"),
    )
    both = tracked.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    order = [F.col("_new").desc(), F.col("ingested_at").desc(), F.col("mtime").desc()]
    return latest_per_key(both, ["file_path"], order).drop("_new")


def empty_tracking(spark: SparkSession) -> DataFrame:
    """A tracking table before the first run."""
    return spark.createDataFrame([], schemas.TRACKING)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, hdfs, s3, gs) and the path in it, for use in tasks."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def read_text(path: str) -> str | None:
    """A file's text; None if it cannot be read or is not UTF-8."""
    try:
        store, place = store_of(path)
        with store.open_input_stream(place) as stream:
            return stream.read().decode()
    except (OSError, UnicodeDecodeError):
        return None


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            yield row.append_column("payload", pa.array([read_text(row.column("path")[0].as_py())], pa.string()))


def read_pending(pending: DataFrame) -> DataFrame:
    """Contents of the pending files (NULL payload where unreadable or not UTF-8). No other file is opened.

    Files are dealt to tasks by path and read one at a time.
    """
    tasks = int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"`{c}` {t}" for c, t in pending.dtypes)
    return pending.repartition(tasks, "path").mapInArrow(_read_batches, f"{schema}, payload string")


def tag_documents(docs: DataFrame) -> DataFrame:
    """Documents with hash, league, season and, for those to set aside, a ``reason``.

    Invalid JSON and a season that is neither a year nor a range are set aside; an unknown league code
    is kept with NULL league and season.
    """
    token = file_season_token("file_name")
    tagged = docs.withColumns({
        "content_hash": canonical_hash("payload"), "league": file_league("file_name"), "season": normalize_season(token),
    })
    bad_season = token.isNotNull() & F.col("season").isNull()
    return tagged.withColumn("reason", F.when(F.col("content_hash").isNull(), "invalid json").when(bad_season, "bad season"))


def split_documents(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records ready for bronze, quarantined documents with a reason)."""
    good = tagged.filter("reason is null").drop("reason")
    return good, tagged.filter("reason is not null").select("rel_path", "source", "entity_type", "reason")


def short_paths(short: DataFrame) -> DataFrame:
    """Files at a too short path as quarantined documents."""
    none = F.lit(None).cast("string")
    return short.select("rel_path", none.alias("source"), none.alias("entity_type"), F.lit("short path").alias("reason"))


def parse_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tagged and split in one go, the rest of the batch goes on without the bad documents."""
    return split_documents(tag_documents(docs))


def save_raw(df: DataFrame, root: str) -> None:
    """Append JSON rows below source / entity_type / date, never overwriting."""
    df.write.partitionBy("source", "entity_type", "date").mode("append").json(root)


def _save_batches(root: str, replace: bool):
    schema = pa.schema([("rel_path", pa.string()), ("written", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        for batch in batches:
            out = []
            for rel_path, payload in zip(batch.column("rel_path").to_pylist(), batch.column("payload").to_pylist()):
                folder, place = f"{base}/{rel_path}".rsplit("/", 1)[0], f"{base}/{rel_path}"
                fresh = replace or store.get_file_info(place).type == fs.FileType.NotFound
                if fresh:
                    store.create_dir(folder, recursive=True)
                    # written beside its place and moved there whole; hidden names are not listed
                    partial = f"{folder}/.{uuid.uuid4().hex}"
                    with store.open_output_stream(partial) as stream:
                        stream.write((payload or "").encode())
                    store.move(partial, place)
                out.append((rel_path, fresh))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(schema.types)], schema=schema)

    return run


def save_documents(docs: DataFrame, root: str, replace: bool = False) -> DataFrame:
    """Each row's ``payload`` as a file of its own at source / entity_type / date / file_name below ``root``.

    A file that exists is left as it is unless ``replace``. Returns ``rel_path`` and whether it was ``written``, computed once.
    """
    placed = docs.select(F.concat_ws("/", "source", "entity_type", "date", "file_name").alias("rel_path"), "payload")
    return cut_lineage(placed.mapInArrow(_save_batches(root, replace), "rel_path string, written boolean"))


def not_collected_today(work: DataFrame, files: DataFrame, today: str, entity_type: str) -> DataFrame:
    """E5: work items (code, season, club_id) without a file of today's date."""
    done = files.filter((F.col("date") == today) & (F.col("entity_type") == entity_type)).withColumn(
        "_prefix", F.regexp_extract("file_name", r"^(.*)_[0-9]{6}_[0-9]+\.json$", 1)
    )
    keyed = work.withColumn("_prefix", F.concat_ws("_", "code", "season", F.col("club_id").cast("string")))
    return without(keyed, done, ["_prefix"]).drop("_prefix")
