"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

The terms of a text are its words and pairs of neighbouring words; every distinct term's hash votes on each of 128 signed bits with
the term's weight (damped counts). Of texts that share four fifths of their five-word shingles, about one word in 45 differs,
which turns 9 bits in the middle and 13 in nine cases of ten; unrelated texts of one language differ in 40 bits or more.

The search keeps permuted block tables: the bits are cut into ``BLOCKS`` blocks and each table is keyed by one of them, as if the
bits were permuted to bring it to the front. Two fingerprints that differ in at most ``RADIUS`` bits agree in some block but for
one bit at most, so looking up a block and its neighbours one bit off meets every such pair in an equi join; the exact distance
is part of the join. Equal fingerprints share one entry, so a group of copies costs one row per table.

``with_next`` pairs each document with the one that follows in ascending id: the table is cut into ranges of the order (id, text hash,
row), so that rows of one id or without id are cut like others; every range is one partition, sorted and read as a stream, and
the first row of every range is also sent to the range before. Texts are compressed before they are shuffled, once.

Null and empty texts have no terms and the fingerprint of all zero bits; likeness between two texts without terms is 1. Rows
that repeat an id follow each other in the order of their text hashes, rows without id come last. Ids must be integers (others
raise a cast error). Texts are handled one at a time whatever their length. An empty table gives no rows. Columns besides those named
are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import WORD, checkpointed

BITS = 128
RUNS = 2
#: Radius of the search and blocks of a fingerprint: eight tables keyed by 16 bits.
RADIUS, BLOCKS = 15, 8

_WORD = re.compile(WORD)
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1)
_SLOT = (np.arange(BITS // 8) * 256)[None, :]
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (shift, multiply)."""
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Hashes of words, kept for words seen lately."""

    def __init__(self, most: int = 300_000):
        self.most, self.known = most, {}

    def words(self, text: str) -> np.ndarray:
        known, found = self.known, _WORD.findall(text)
        if len(known) > self.most:
            known.clear()
        out = [known.get(w) for w in found]
        for k, h in enumerate(out):
            if h is None:
                out[k] = known[found[k]] = xxhash.xxh3_64_intdigest(found[k])
        return np.array(out, dtype=np.uint64)


def fingerprint(words: np.ndarray) -> bytes:
    """The fingerprint of a text from its word hashes."""
    if not len(words):
        return bytes(BITS // 8)
    terms, weights, run = [], [], words
    for n in range(1, min(RUNS, len(words)) + 1):
        if n > 1:
            run = _mixed(run[: len(words) - n + 1] * np.uint64(3) + words[n - 1 :])
        each, counts = np.unique(run, return_counts=True)
        terms.append(each)
        weights.append(1 + np.log(counts))
    term, weight = np.concatenate(terms), np.concatenate(weights)
    halves = np.stack([_mixed(term + np.uint64(k + 1)) for k in range(BITS // 64)], axis=1)
    octets = halves.view(np.uint8).reshape(len(term), BITS // 8)
    votes = np.bincount((octets + _SLOT).ravel(), np.repeat(weight, BITS // 8), minlength=256 * (BITS // 8)).reshape(-1, 256) @ _SIGNS
    return np.packbits(votes.ravel() > 0).tobytes()


def likeness(distance: Column, bits: int = BITS) -> Column:
    """From 1 (equal) to 0 (unrelated, half of the bits differ): the cosine that the share of differing bits estimates."""
    return F.greatest(F.lit(0.0), F.cos(distance * (3.141592653589793 / bits)))


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two fingerprints as hex strings of 32 digits."""
    part = lambda c, k: F.conv(F.substring(c, 8 * k + 1, 8), 16, 10).cast("long")
    return sum((F.bit_count(part(a, k).bitwiseXOR(part(b, k))) for k in range(BITS // 32)), F.lit(0))


def _edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


# --- neighbours in id order ---------------------------------------------------


def _places(docs: DataFrame, ranges: int) -> list[tuple]:
    """Where the sorted table (null ids last, then id, text hash, row) is cut, from a sample of fixed size per range."""
    sample = sorted(_rank(r.doc_id, r.tie, r.row) for r in _drawn(docs, 20 * ranges).collect())
    return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []


def _drawn(docs: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` rows drawn evenly: rows are dealt to as many slots and each keeps the least draw. Tasks meet by slot on the executors;
    the first rows of a sorted table would be sent to the driver by every task."""
    draw = F.xxhash64("row", F.lit(11))
    dealt = docs.select(F.pmod(F.xxhash64("row", F.lit(12)), F.lit(most)).alias("slot"), draw.alias("draw"), "doc_id", "tie", "row")
    return dealt.groupBy("slot").agg(*[F.min_by(c, "draw").alias(c) for c in ("doc_id", "tie", "row")])


def _rank(doc_id: int | None, tie: int, row: int) -> tuple:
    return (doc_id is None, doc_id or 0, tie, row)


def _first_rows(places: list[tuple]):
    """The first row of every range that a batch has rows of."""

    def run(batches):
        for batch in batches:
            least: dict[int, tuple] = {}
            for rank in map(_rank, *(batch.column(c).to_pylist() for c in ("doc_id", "tie", "row"))):
                slot = bisect_right(places, rank)
                least[slot] = min(least.get(slot, rank), rank)
            rows = [(slot, *rank) for slot, rank in least.items()]
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["slot", "nameless", "doc_id", "tie", "row"])

    return run


_PLACED = pa.schema([
    ("slot", pa.int32()), ("guest", pa.bool_()), ("nameless", pa.bool_()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("row", pa.int64()),
    ("fingerprint", pa.binary()), ("packed", pa.binary())])


def _placed_rows(places: list[tuple], guests: dict[tuple, int]):
    """Every row with its range, fingerprint and compressed text; the first row of a range also as guest of the range before."""

    def run(batches):
        hasher, packer = Hasher(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                part = batch.slice(at, 256)
                for doc_id, tie, row, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "tie", "row", "text"))):
                    rank, text = _rank(doc_id, tie, row), text or ""
                    kept = (rank[0], doc_id, tie, row, fingerprint(hasher.words(text)), packer.compress(text.encode()))
                    out.append((bisect_right(places, rank), False, *kept))
                    if rank in guests:
                        out.append((guests[rank], True, *kept))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_PLACED)], schema=_PLACED)

    return run


_PAIRED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), *[(n, pa.string()) for n in ("fingerprint", "edited_fingerprint", "next_fingerprint")]])


def _pair_rows(batches):
    """Streams the sorted rows of one range; every row meets the one that follows it, the last one the guest."""
    hasher, unpacker, held = Hasher(), zstandard.ZstdDecompressor(), None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            out, part = [], batch.slice(at, 256)
            for guest, doc_id, mark, packed in zip(*(part.column(c).to_pylist() for c in ("guest", "doc_id", "fingerprint", "packed"))):
                text = unpacker.decompress(packed).decode()
                if held:
                    own_id, own_text, own_mark = held
                    edit = _edited(own_text, text)
                    out.append((own_id, len(own_text), edit, own_mark.hex(), fingerprint(hasher.words(edit)).hex(), mark.hex()))
                held = None if guest else (doc_id, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_PAIRED)], schema=_PAIRED)
    if held:
        raise RuntimeError(f"no row follows id {held[0]}: the table was not read twice in the same order")


def with_next(df: DataFrame, text: str = "text", doc_id: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Per document: ``n_chars``, the ``edited`` text (last quarter replaced by the start of the next document), and the
    fingerprints, as hex strings, of the text, of the edited text and of the next document's text.

    ``ranges`` defaults to the session's shuffle partitions; the driver learns where they begin and a sample of 20 rows for each.
    ``df`` is read three times and must give its rows in the same order each time, as a table does.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")
    places = _places(docs, ranges)
    least = docs.select("doc_id", "tie", "row").mapInArrow(_first_rows(places), "slot int, nameless boolean, doc_id long, tie long, row long")
    firsts = sorted(least.groupBy("slot").agg(F.min(F.struct("nameless", "doc_id", "tie", "row")).alias("r")).collect())
    guests = {tuple(r["r"]): firsts[k - 1]["slot"] for k, r in enumerate(firsts)}
    schema = "slot int, guest boolean, nameless boolean, doc_id long, tie long, row long, fingerprint binary, packed binary"
    placed = docs.mapInArrow(_placed_rows(places, guests), schema)
    ordered = placed.repartitionById(len(places) + 1, F.col("slot")).sortWithinPartitions("guest", "nameless", "doc_id", "tie", "row")
    schema = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, next_fingerprint string"
    return ordered.select("guest", "doc_id", "fingerprint", "packed").mapInArrow(_pair_rows, schema)


# --- search -----------------------------------------------------------------


def _block(mark: Column, k: int, blocks: int) -> Column:
    """Block ``k`` of a fingerprint (hex string) as a number."""
    digits = BITS // 4 // blocks
    return F.conv(F.substring(mark, k * digits + 1, digits), 16, 10).cast("int")


def within_radius(marks: DataFrame, wanted: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, doc_id: str = "doc_id") -> DataFrame:
    """For each different ``fingerprint`` of ``wanted``: every different ``fingerprint`` of ``marks`` within the radius as ``near``,
    with its ``distance``, the least ``near_id`` of the rows that carry it (null without a column ``doc_id``) and their number ``rows``.

    All are found: of two fingerprints that differ in fewer than ``2 * blocks`` bits, some block differs in one bit at most. Table
    ``k`` is keyed by block ``k``; a query looks up its own block there and all values one bit off. The distance is part
    of the join condition, and a pair counts in the first table that holds it, so pairs are neither listed twice nor shuffled.

    Every query becomes ``blocks * (1 + bits of a block)`` rows, of which Spark's sizes know nothing: they are cut by number rather than
    by size, and the join is hinted to merge, as the sizes would have it broadcast them.
    """
    if radius >= 2 * blocks or BITS // 4 % blocks:
        raise ValueError(f"{blocks} blocks find distances below {2 * blocks} only, and must divide {BITS // 4} digits")
    width = BITS // blocks
    least = F.min(doc_id) if doc_id in marks.columns else F.lit(None).cast("long")
    stock = checkpointed(marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"), least.alias("near_id")))
    values = lambda c: F.array(*[_block(F.col(c), k, blocks) for k in range(blocks)])
    keyed = stock.select(F.col("fingerprint").alias("near"), "near_id", "rows", values("fingerprint").alias("theirs"))
    keyed = keyed.select("*", F.posexplode("theirs").alias("table", "value"))
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = wanted.select("fingerprint").distinct().repartition(parts).select("fingerprint", values("fingerprint").alias("ours"))
    flips = F.array(F.lit(0), *[F.lit(1 << k) for k in range(width)])
    asking = asked.select("fingerprint", "ours", F.posexplode("ours").alias("table", "own"))
    asking = asking.select("*", F.explode(F.transform(flips, lambda f: F.col("own").bitwiseXOR(f))).alias("value")).drop("own")
    apart = F.zip_with("ours", "theirs", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    near = keyed.join(asking.hint("merge"), ["table", "value"])
    near = near.withColumn("apart", apart).filter(F.aggregate("apart", F.lit(0), lambda a, x: a + x) <= radius)
    first = F.array_position(F.transform("apart", lambda n: n <= 1), True) == F.col("table") + 1
    return near.filter(first).select("fingerprint", "near", "near_id", "rows", F.aggregate("apart", F.lit(0), lambda a, x: a + x).alias("distance"))


def classes(marks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``fingerprint`` and ``class_id``, the least id that carries it."""
    return marks.groupBy("fingerprint").agg(F.min(doc_id).alias("class_id"))
