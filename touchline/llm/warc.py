"""WARC archives with a two-level capture index (operator 11).

**Writing.** One pass hashes every payload, small rows of (digest, id) find the least id of each repeated payload, and only rows
whose (digest, id) may be a repeat are shuffled once more for the exact answer; everything else is written where it is read. A
task streams its rows into archives of its own (one gzip member per record, a new file after ``ARCHIVE_BYTES``). File names are
unique per attempt and the table of captures lists the files of committed attempts only, so a lost executor or a second attempt
leaves at most an unlisted file behind.

**Index.** Captures are range-sorted by (reversed-host URL key, id, file, offset) into shards. A shard is one file: compressed
blocks of ``BLOCK_LINES`` lines, then a sparse directory with the first key of each block. The shard table holds one row per
shard: its first and last key and where its directory lies. A hot URL simply fills several shards, because the sort key is unique.

**Reading.** Wanted URLs go to the shards whose range holds their key (by bisection), a task reads that shard's directory, bisects
it, reads the one or few blocks that can hold the key, and returns archive, offset and length. ``fetch`` groups captures by
archive and stretch, and reads neighbouring records with one range read.

Hard rows: a null or empty payload is a record without payload; a null URL has the key of the empty string and no target header;
null ids are never the least id, rows that repeat the least id with its payload are responses as well, and payloads below
``LEAST_BYTES`` are always responses. URL keys above ``KEY_CHARS`` code points are shortened to their beginning and a digest; the
entry holds the URL itself and the comparison is exact. Records are handled one at a time whatever their length. An empty table
gives no archive, an index without shards and no rows. Columns besides the three named are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import may_hold

ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 512
KEY_CHARS = 1024
LEAST_BYTES = 100
#: Records of one archive within a stretch are fetched by one task; ranges closer than GAP are read together, up to READ bytes.
STRETCH, READ, GAP = 1 << 25, 1 << 23, 1 << 16
#: Copies of a repeated digest's row, so that the rows of a hot payload spread over as many tasks.
SALTS = 16

CAPTURES = "key string, mark string, url string, kind string, file string, offset bigint, length bigint"
SHARDS = "file string, first_key string, first_mark string, last_key string, last_mark string, at bigint, size bigint, lines bigint"
RECORDS = "id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string"


@dataclass(frozen=True)
class Index:
    """A capture index: its folder, the folder of the archives, and one row per shard (at most the shard number asked for)."""

    folder: str
    archives: str
    shards: tuple


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def url_key(url: str | None) -> str:
    """Reversed host, port, path and query: ``http://www.example.com/a?b`` gives ``com,example,www)/a?b``."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host = (parts.hostname or "").rstrip(".")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        parts, host, port = None, "", ""
    if not host:
        key = text
    else:
        key = ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    if len(key) <= KEY_CHARS:
        return key
    return f"{key[: KEY_CHARS - 65]}~{hashlib.sha256(key.encode('utf-8', 'surrogatepass')).hexdigest()}"


# --- writing ----------------------------------------------------------------


def _repeats(base: DataFrame, least_bytes: int) -> DataFrame:
    """(digest, id, first): every pair whose payload has a smaller id as its first. Only small rows are shuffled."""
    pairs = base.filter(F.col("n") >= least_bytes).groupBy("digest", "id").agg(F.count(F.lit(1)).alias("rows"))
    firsts = pairs.groupBy("digest").agg(F.min("id").alias("first"), F.sum("rows").alias("rows"))
    firsts = firsts.filter((F.col("rows") > 1) & F.col("first").isNotNull()).select("digest", "first")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    spread = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(spread, ["digest", "salt"]).filter(~F.col("id").eqNullSafe(F.col("first"))).select("digest", "id", "first")


def _mark(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _header(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256('|'.join(parts).encode('utf-8', 'surrogatepass')).digest()[:16])}>"


def _safe(value: str) -> str:
    """Percent-encodes what would break a header line; ``unquote`` gives the value back."""
    return quote(value, safe="!#$&'()*+,/:;=?@[]-._~", errors="surrogatepass")


def record(mark: str, url: str | None, digest: str, size: int, first: str | None, payload: bytes, date: str) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit that names the response's id."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", _record_id(mark, url or "", digest)), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", _safe(url)))
    lines += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Page-ID", _safe(mark))]
    if first is not None:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-ID", _safe(first))]
    block = http + (payload if first is None else b"")
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(_header(lines) + block + b"\r\n\r\n") + packer.flush()


def _write_archives(folder: str, date: str, archive_bytes: int):
    schema = pa.schema([(c, pa.string()) for c in ("key", "mark", "url", "kind", "file")] + [("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        sink, name, at = None, None, 0
        for batch in batches:
            done = []
            columns = [batch.column(c) for c in ("mark", "url", "digest", "n", "first", "html")]
            for k in range(batch.num_rows):
                mark, url, digest, size, first, payload = (c[k].as_py() for c in columns)
                if sink is None:
                    store.create_dir(root, recursive=True)
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record(mark, url, digest, size, first, payload or b"", date)
                sink.write(member)
                done.append((url_key(url), mark, url, "response" if first is None else "revisit", name, at, len(member)))
                at += len(member)
                if at >= archive_bytes:
                    sink.close()
                    sink = None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)] if done else [pa.array([], t) for t in schema.types], schema=schema)
        if sink is not None:
            sink.close()

    return run


def write(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = LEAST_BYTES, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every row as a record below ``folder``/archives and return the table of captures, kept in ``folder``/captures."""
    spark, folder = pages.sparkSession, folder.rstrip("/")
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    base = pages.select(
        F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("html"))
    base = base.withColumns({"digest": F.unhex(F.sha2("html", 256)), "n": F.octet_length("html").cast("long")})
    repeats_at = f"{folder}/repeats"
    _repeats(base.select("id", "digest", "n"), least_bytes).write.parquet(repeats_at)
    repeats = spark.read.parquet(repeats_at)
    tried = may_hold(base, F.xxhash64("digest", "id"), repeats, F.xxhash64("digest", "id"), "maybe")
    tried = tried.withColumn("maybe", F.col("maybe") & (F.col("n") >= least_bytes))
    sure = tried.filter(~F.col("maybe")).withColumn("first", F.lit(None).cast("string"))
    again = repeats.select(F.col("digest").alias("d"), F.col("id").alias("i"), _mark(F.col("first")).alias("first"))
    doubtful = tried.filter("maybe").join(again, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left")
    rows = [df.select(_mark(F.col("id")).alias("mark"), "url", F.lower(F.hex("digest")).alias("digest"), "n", "first", F.when(F.col("first").isNull(), F.col("html")).alias("html")) for df in (sure, doubtful)]
    rows[0].unionByName(rows[1]).mapInArrow(_write_archives(f"{folder}/archives", date, archive_bytes), CAPTURES).write.parquet(f"{folder}/captures")
    return spark.read.schema(CAPTURES).parquet(f"{folder}/captures")


# --- index ------------------------------------------------------------------


def _write_shards(folder: str, block_lines: int):
    names = ["file", "first_key", "first_mark", "last_key", "last_mark", "at", "size", "lines"]
    schema = pa.schema([(c, pa.string()) for c in names[:5]] + [(c, pa.int64()) for c in names[5:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        sink, name, lines, directory, total, first, last = None, None, [], [], 0, None, None

        def close_block() -> None:
            packed = zlib.compress("\n".join(lines).encode("utf-8", "surrogatepass"))
            directory.append((*json.loads(lines[0])[:2], sink.tell(), len(packed)))
            sink.write(packed)
            lines.clear()

        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    store.create_dir(root, recursive=True)
                    name = f"shard-{uuid.uuid4().hex}.cdx"
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    first = entry[:2]
                lines.append(json.dumps(entry))
                last, total = entry[:2], total + 1
                if len(lines) == block_lines:
                    close_block()
        if sink is None:
            return
        if lines:
            close_block()
        at, packed = sink.tell(), zlib.compress(json.dumps(directory).encode())
        sink.write(packed + struct.pack("<QQ", at, len(packed)))
        sink.close()
        yield pa.RecordBatch.from_pylist([dict(zip(names, (name, *first, *last, at, len(packed), total)))], schema)

    return run


def build_index(captures: DataFrame, folder: str, shards: int | None = None, block_lines: int = BLOCK_LINES) -> Index:
    """Sort ``captures`` into at most ``shards`` files (default: the session's shuffle partitions) and return the index."""
    spark, folder = captures.sparkSession, folder.rstrip("/")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "mark", "file", "offset"]
    lined = captures.select("key", "mark", "url", "kind", "file", "offset", "length")
    lined.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(_write_shards(f"{folder}/index", block_lines), SHARDS).write.parquet(f"{folder}/shards")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> Index:
    """An index written before. Its shard table has at most as many rows as the shards asked for."""
    folder = folder.rstrip("/")
    rows = spark.read.schema(SHARDS).parquet(f"{folder}/shards").collect()
    ranked = sorted(tuple(r) for r in rows)
    return Index(f"{folder}/index", f"{folder}/archives", tuple(sorted(ranked, key=lambda r: (r[1], r[2], r[3], r[4]))))


# --- reading ----------------------------------------------------------------


def _route(index: Index):
    """To each wanted URL the shards whose range holds its key, found by bisection over first and last keys."""
    firsts = [(s[1], s[2]) for s in index.shards]
    lasts = [(s[3], s[4]) for s in index.shards]
    schema = pa.schema([("shard", pa.int32()), ("key", pa.string()), ("mark", pa.string()), ("url", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url, mark in zip(batch.column("url").to_pylist(), batch.column("mark").to_pylist()):
                key = url_key(url)
                low = (key,) if mark is None else (key, mark)
                high = (key, "\U0010ffff") if mark is None else (key, mark)
                out += [(s, key, mark, url) for s in range(bisect_left(lasts, low), bisect_right(firsts, high))]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(schema.types)], schema=schema)

    return run


class _Shard:
    """One shard file: its directory, and the block read last."""

    def __init__(self, store: fs.FileSystem, root: str, row: tuple):
        self.file = store.open_input_file(f"{root}/{row[0]}")
        self.directory = json.loads(zlib.decompress(self.file.read_at(row[6], row[5])))
        self.firsts = [tuple(d[:2]) for d in self.directory]
        self.held, self.lines = -1, []

    def block(self, k: int) -> list[list]:
        if k != self.held:
            _, _, at, size = self.directory[k]
            text = zlib.decompress(self.file.read_at(size, at)).decode("utf-8", "surrogatepass")
            self.held, self.lines = k, [json.loads(line) for line in text.split("\n")]
        return self.lines

    def find(self, key: str, mark: str | None, url: str | None) -> Iterator[list]:
        """Entries of the URL (and id): bisect the directory, then the blocks that can hold the key."""
        low = [key] if mark is None else [key, mark]
        k = max(bisect_left(self.firsts, tuple(low)) - 1, 0)
        while k < len(self.directory) and list(self.firsts[k][: len(low)]) <= low:
            lines = self.block(k)
            for line in lines[bisect_left(lines, low) :]:
                if line[: len(low)] != low:
                    break
                if line[2] == url:
                    yield line
            k += 1


def _search(index: Index):
    schema = pa.schema([(c, pa.string()) for c in ("key", "mark", "url", "kind", "file")] + [("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(index.folder)
        current, shard = None, None
        for batch in batches:
            out = []
            for s, key, mark, url in zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "mark", "url"))):
                if s != current:
                    current, shard = s, _Shard(store, root, index.shards[s])
                out += shard.find(key, mark, url)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(schema.types)], schema=schema)

    return run


def find(index: Index, wanted: DataFrame, url: str = "url", page_id: str | None = None) -> DataFrame:
    """The captures of the wanted URLs, with ``page_id`` those of the wanted (URL, id) pairs; each wanted one counts once."""
    mark = F.lit(None).cast("string") if page_id is None else _mark(F.col(f"`{page_id}`"))
    probes = wanted.select(F.col(f"`{url}`").cast("string").alias("url"), mark.alias("mark")).distinct()
    routed = probes.mapInArrow(_route(index), "shard int, key string, mark string, url string")
    # a given number of partitions: rows are small, what they read is not, so they are not to be packed by their size
    near = routed.repartition(max(1, len(index.shards)), "shard").sortWithinPartitions("shard", "key", "mark")
    return near.mapInArrow(_search(index), CAPTURES)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _unmark(value: str | None) -> str | None:
    return unquote(value)[1:] if value else None


def read_record(member: bytes) -> tuple[tuple, bytes]:
    """A row of ``RECORDS`` and the payload stored; a response's digest is computed anew and must agree."""
    fields, http, payload = parse(member)
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
    if fields["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload it names")
    uri = fields.get("WARC-Target-URI")
    return (_unmark(fields["Page-ID"]), None if uri is None else unquote(uri), fields["WARC-Type"], size, digest, _unmark(fields.get("Refers-To-Page-ID"))), payload


def _fetch(archives: str, with_payload: bool):
    fields = [("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]
    schema = pa.schema(fields + ([("payload", pa.binary())] if with_payload else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(archives)
        name, source = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            k = 0
            while k < len(places):
                file, start, length = places[k]
                stop, end = start + length, k + 1
                while end < len(places) and places[end][0] == file and places[end][1] - stop <= GAP and places[end][1] + places[end][2] - start <= READ:
                    stop, end = max(stop, places[end][1] + places[end][2]), end + 1
                if file != name:
                    name, source = file, store.open_input_file(f"{root}/{file}")
                piece = source.read_at(stop - start, start)
                rows = []
                for _, at, size in places[k:end]:
                    row, payload = read_record(piece[at - start : at - start + size])
                    rows.append((*row, payload) if with_payload else row)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(schema.types)], schema=schema)
                k = end

    return run


def fetch(captures: DataFrame, index: Index, with_payload: bool = False) -> DataFrame:
    """The records at ``captures`` (file, offset, length), each read back from its archive; a revisit stores no payload."""
    near = captures.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / STRETCH))
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = near.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(_fetch(index.archives, with_payload), RECORDS + (", payload binary" if with_payload else ""))
