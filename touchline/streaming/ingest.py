"""Incremental ingest of new and changed snapshot files."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.lineage import cut_lineage
from touchline.sources.bronze import insert_new
from touchline.sources.files import read_text, short_paths, split_documents, store_of, tag_documents

#: Files that one task of the source opens.
FILES_PER_TASK = 64


@dataclass
class Files(InputPartition):
    """Files of one task: path, path below the root and change marks of each."""

    entries: list[tuple[str, str, int, int]]

    def __init__(self, entries: list[tuple[str, str, int, int]]):
        super().__init__(None)
        self.entries = entries


class RawTree(DataSource):
    """The raw snapshot tree ``root``/source/entity type/date/file as a stream of whole documents.

    Options: ``root``; ``source`` and ``since`` (a date) select folders while listing. Offsets are (date folder, change time,
    files of that very time): a trigger takes the files changed after the last offset, whether new or edited in place, and opens no
    other.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_tree"

    def schema(self) -> str:
        return (
            "rel_path string, source string, entity_type string, date string, file_name string, mtime timestamp, "
            "size_bytes bigint, payload string"
        )

    def streamReader(self, schema) -> TreeStream:
        return TreeStream(self.options["root"], self.options.get("source"), self.options.get("since"))


class TreeStream(DataSourceStreamReader):
    """Lists folders on the driver (names and change times only); files are opened in tasks."""

    def __init__(self, root: str, source: str | None, since: str | None):
        self.root, self.source, self.since = root, source, since

    def _changed(self, after: dict, until: int | None) -> Iterator[tuple[str, str, int, int]]:
        """Files changed after an offset; of those changed in its very instant, the ones that it does not name."""
        store, base = store_of(self.root)

        def below(folder: str, depth: int) -> Iterator[fs.FileInfo]:
            for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.base_name.startswith((".", "_")):
                    continue
                if info.type == fs.FileType.Directory:
                    skipped = depth == 0 and self.source and info.base_name != self.source or depth == 2 and self.since and info.base_name < self.since
                    if not skipped:
                        yield from below(info.path, depth + 1)
                elif info.base_name.endswith(".json"):
                    yield info

        for info in below(base.rstrip("/"), 0):
            rel_path, changed = info.path[len(base.rstrip("/")) + 1 :], info.mtime_ns
            fresh = changed > after["changed_ns"] or changed == after["changed_ns"] and rel_path not in after["at"]
            if fresh and (until is None or changed <= until):
                yield info.path, rel_path, changed, info.size

    def initialOffset(self) -> dict:
        return {"date": "", "changed_ns": 0, "at": []}

    def latestOffset(self) -> dict:
        latest = self.initialOffset()
        for _, rel_path, changed, _ in self._changed(latest, None):
            parts = rel_path.split("/")
            latest["date"] = max(latest["date"], parts[2] if len(parts) > 3 else "")
            if changed > latest["changed_ns"]:
                latest |= {"changed_ns": changed, "at": []}
            if changed == latest["changed_ns"]:
                latest["at"] = sorted([*latest["at"], rel_path])
        return latest

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        found = sorted(self._changed(start, end["changed_ns"]), key=lambda f: f[1])
        return [Files(found[k : k + FILES_PER_TASK]) for k in range(0, len(found), FILES_PER_TASK)]

    def read(self, partition: Files) -> Iterator[tuple]:
        from datetime import datetime, timezone

        scheme = "" if "://" not in self.root or self.root.startswith("file:") else self.root.split("://")[0] + "://"
        for path, rel_path, changed, size in partition.entries:
            parts = rel_path.split("/")
            placed = (parts[0], parts[1], parts[2]) if len(parts) > 3 else (None, None, None)
            moment = datetime.fromtimestamp(changed / 1e9, timezone.utc)
            yield (rel_path, *placed, parts[-1], moment, size, read_text(scheme + path))


def stream_documents(spark: SparkSession, root: str, source: str | None = None, since: str | None = None) -> DataFrame:
    """New and edited files below ``root`` as whole documents with their path parts (NULL source: the path is too short)."""
    spark.dataSource.register(RawTree)
    reader = spark.readStream.format("raw_tree").option("root", root)
    for name, value in (("source", source), ("since", since)):
        reader = reader if value is None else reader.option(name, value)
    return reader.load()


def start_ingest(
    spark: SparkSession, root: str, bronze_path: str, quarantine_path: str, checkpoint: str
) -> StreamingQuery:
    """Drain the files changed since the last run into bronze and stop.

    A replayed batch adds nothing: records already in bronze are dropped by key. Documents that cannot be used and files at
    short paths go to the quarantine with a reason.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        docs = cut_lineage(tag_documents(batch))
        good, bad = split_documents(docs.filter("source is not null"))
        insert_new(good, bronze_path)
        bad.unionByName(short_paths(docs.filter("source is null"))).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")

    return (
        stream_documents(spark, root)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
