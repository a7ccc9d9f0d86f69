"""Near-duplicate documents by MinHash, banding, verification on full shingle sets, and connected components.

1. One pass over the texts makes per document its shingle set's digest and, from many universal hash minima, the keys of its
   bands and a one-byte-per-minimum signature. Documents with equal sets form a class and go on as one node.
2. Nodes that share a band key are candidates. First every node meets one centre, the smallest node of its buckets. Along the links
   that hold, nodes take over the label of their centre's centre, which settles most of every large group with one comparison per
   node.
3. What is left are pairs of one bucket in different components. Signatures are compared inside the tasks: first each node
   offers its likeliest partner, and labels are handed over the links that hold. Then, for every remaining pair whose signatures allow the threshold, the node of the smaller
   component visits the other's home (the group of its centre): one row per visitor and home, however many pairs that covers.
   There an index over the members' full sets gives the visitor's exact overlap with each. So no link between different
   components is missed, and pairs are never listed.
4. Every link is confirmed on full sets, from texts fetched for the candidates only. Labels only save comparisons; the components
   are searched once, over all links confirmed.

Signature filters lie five standard deviations below the threshold, and the bands miss a pair at the threshold with
probability below 1e-6. Buckets larger than ``BLOCK`` are compared block against block in separate tasks; centres of many
nodes are split by count, homes by the size of their sets and by the number of their visitors. Texts are pre-filtered by a bitmap of fixed size before they are shuffled.

Words, shingles: ASCII capitals are lowered; a text with fewer words than a shingle has one shingle, all its words. Null texts
and texts without words have no shingles, link with nothing and are kept. Rows without id take no part, have no component and
are kept. Rows that repeat an id are each judged by their own text. Ids must be integers (others raise a cast error). Texts are handled one at
a time whatever their length; an empty table gives no rows; columns besides those named are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, may_hold, packed, possible_rows, release
from touchline.llm.components import components

#: Rows of a bucket that one task compares with each other, and members of one centre in one group.
BLOCK = 2048
#: Shingles that one part of a home holds in memory, and members and visitors that it has, about.
HOME_SHINGLES, VISITORS = 1_000_000, 512


@dataclass(frozen=True)
class Settings:
    """Words per shingle, similarity in per cent, bands and minima per band."""

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def least_likeness(self) -> float:
        """Share of equal signature bytes below which a pair cannot reach the threshold (five standard deviations off)."""
        t = self.percent / 100
        return t - 5 * math.sqrt(t * (1 - t) / self.minima)


STRICT = Settings(shingle=3, percent=85, bands=36, rows=6)

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Shingle sets as sorted distinct 64-bit hashes."""

    def __init__(self, size: int, most: int = 300_000):
        self.size, self.most, self.known = size, most, {}

    def set_of(self, text: str | None) -> np.ndarray:
        found = (text or "").encode().lower().split()  # of bytes: ASCII capitals and ASCII white space only
        if not found:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > self.most:
            known.clear()
        hashes = [known.get(w) for w in found]
        for k, h in enumerate(hashes):
            if h is None:
                hashes[k] = known[found[k]] = xxhash.xxh3_64_intdigest(found[k])
        words = np.array(hashes, dtype=np.uint64)
        n = min(self.size, len(words))
        out = _mixed(words[: len(words) - n + 1] + np.uint64(n))
        for k in range(1, n):
            out = _mixed(out * np.uint64(3) + words[k : len(words) - n + 1 + k])
        return np.unique(out)


class Minima:
    """Universal hash functions a*x + b modulo 2^64 and the minima of a set under them."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(20240229)
        self.a = rng.integers(0, 1 << 63, settings.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, settings.minima, dtype=np.uint64)
        self.settings = settings

    def of(self, values: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(values), 256):
            part = values[at : at + 256, None] * self.a
            part += self.b
            np.minimum(best, part.min(axis=0), out=best)
        return best

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """One signed key per band; the band's number is part of it."""
        rows = minima.reshape(self.settings.bands, self.settings.rows)
        key = _mixed(np.arange(self.settings.bands, dtype=np.uint64) + np.uint64(1))
        for k in range(self.settings.rows):
            key = _mixed(key * np.uint64(3) + rows[:, k])
        return key.view(np.int64)


def signatures(df: DataFrame, settings: Settings, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``digest`` of its set, ``bands`` and ``signature`` (null without words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

    def run(batches):
        shingler, minima = Shingler(settings.shingle), Minima(settings)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[list] = [part.column(0).to_pylist(), [], [], [], []]
                for value in part.column(1):
                    shingles = shingler.set_of(value.as_py())
                    least = minima.of(shingles) if len(shingles) else None
                    row = (
                        len(shingles),
                        xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None,
                        None if least is None else minima.keys(least),
                        None if least is None else (_mixed(least) & np.uint64(255)).astype(np.uint8).tobytes(),
                    )
                    for column, v in zip(out[1:], row):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    picked = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary")


def confirmed(docs: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of document ids whose full shingle sets reach the threshold.

    The text of every ``b`` travels to the group of its ``a``, that of ``a`` once per group, where the sets are compared as a
    stream that holds one set at a time.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("members"))
    grouped = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / BLOCK).cast("long")).alias("part"))
    heads = grouped.select("a", F.col("a").alias("node"), "part", F.lit(0).alias("role")).distinct()
    roles = checkpointed(heads.unionByName(grouped.select("a", F.col("b").alias("node"), "part", F.lit(1).alias("role"))))
    texts = possible_rows(docs, roles.select("node"))
    placed = texts.join(roles, F.col("doc_id") == F.col("node")).select("a", "part", "role", "node", "text")
    ordered = placed.repartition("a", "part").sortWithinPartitions("a", "part", "role")
    percent, shingle = settings.percent, settings.shingle

    def run(batches):
        shingler, group, heads = Shingler(shingle), None, []
        for batch in batches:
            linked: list[tuple[int, int]] = []
            columns = [batch.column(c) for c in ("a", "part", "role", "node", "text")]
            for k in range(batch.num_rows):
                a, part, role, node, text = (c[k].as_py() for c in columns)
                if group != (a, part):
                    group, heads = (a, part), []
                own = shingler.set_of(text)
                if role == 0:
                    heads.append(own)
                elif any(_reaches(head, own, percent) for head in heads):
                    linked.append((a, node))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in linked], pa.int64()) for i in (0, 1)], ["a", "b"])

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _offers(rows: DataFrame, settings: Settings, visits: bool) -> DataFrame:
    """From rows sorted by bucket and block pair: pairs of different components whose sizes and signatures allow the threshold.

    Either each node's likeliest partner as pairs ``a``, ``b``, or with ``visits`` for every such pair the node ``a`` of the
    smaller component and the other's home ``b``.
    """
    least, percent = settings.least_likeness, settings.percent
    names = ("key", "i", "j", "block", "node", "component", "n_shingles", "home", "members", "signature")

    def pairs_of(group: list[tuple], i: int, j: int) -> set[tuple[int, int]]:
        block, node, component, size, home, members = (np.array([g[c] for g in group], dtype=np.int64) for c in range(6))
        marks = np.frombuffer(b"".join(g[6] for g in group), dtype=np.uint8).reshape(len(group), -1)
        out: set[tuple[int, int]] = set()
        right = np.flatnonzero(block == j)
        for left in np.array_split(np.flatnonzero(block == i), len(group) // 32 + 1):
            like = (marks[left][:, None, :] == marks[right][None, :, :]).mean(axis=2)
            a, b = size[left][:, None], size[right][None, :]
            fits = (component[left][:, None] != component[right][None, :]) & (like >= least) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
            if not fits.any():
                continue
            if visits:
                r, c = np.nonzero(fits)
                x, y = left[r], right[c]
                first = (members[x] < members[y]) | ((members[x] == members[y]) & (node[x] > node[y]))
                found = np.stack([np.where(first, node[x], node[y]), np.where(first, home[y], home[x])], axis=1)
            else:
                r = np.flatnonzero(fits.any(axis=1))
                x, y = node[left[r]], node[right[np.argmax(np.where(fits, like, -1)[r], axis=1)]]
                found = np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)
            out.update(map(tuple, np.unique(found, axis=0).tolist()))
        return out

    def record(found: set[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in sorted(found)], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches):
        current, group = None, []
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if row[:3] != current:
                    if len(group) > 1:
                        found |= pairs_of(group, *current[1:])
                    current, group = row[:3], []
                group.append(row[3:])
            yield record(found)
        if len(group) > 1:
            yield record(pairs_of(group, *current[1:]))

    return rows.mapInArrow(run, "a long, b long").distinct()


def _across(shared: DataFrame, nodes: DataFrame, settled: DataFrame, settings: Settings, visits: bool) -> DataFrame:
    """Offers between different components of ``settled`` (``node``, ``component``) over the buckets ``shared``."""
    counts = settled.groupBy("component").agg(F.count("*").alias("members"))
    known = settled.join(counts, "component")
    rows = shared.join(known, "node", "left").select(
        "key", "node", "home", F.coalesce("component", "node").alias("component"), F.coalesce("members", F.lit(1)).alias("members"))
    open_keys = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter("low < high")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    still = rows.join(open_keys.select("key", blocks.alias("blocks")), "key").join(nodes.select("node", "n_shingles", "signature"), "node")
    block = F.pmod(F.hash("node"), F.col("blocks"))
    still = still.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    still = still.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    ordered = still.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return _offers(ordered.select("key", "i", "j", "block", "node", "component", "n_shingles", "home", "members", "signature"), settings, visits)


class _Home:
    """An index over the shingle sets of a home's members."""

    def __init__(self, sets: list[np.ndarray], components_of: list[int]):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.sizes, self.components = np.array([len(s) for s in sets]), np.array(components_of)

    def links(self, own: np.ndarray, component: int, percent: int) -> list[int]:
        """A linked member for each other component that has one."""
        low, high = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
        widths = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(widths)[:-1]]), widths) + np.arange(widths.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        linked = (self.components != component) & (100 * common >= percent * (self.sizes + len(own) - common))
        _, first = np.unique(self.components[linked], return_index=True)
        return np.flatnonzero(linked)[first].tolist()


def _visited(docs: DataFrame, nodes: DataFrame, homes: DataFrame, settled: DataFrame, visits: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed links of visitors ``a`` with members of the homes ``b`` that they visit."""
    members = homes.join(visits.select(F.col("b").alias("home")).distinct(), "home").join(nodes.select("node", "n_shingles"), "node")
    calls = visits.select(F.col("b").alias("home"), F.col("a").alias("node"))
    shares = calls.groupBy("home").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("shares"))
    parts = F.greatest(F.ceil(F.sum("n_shingles") / HOME_SHINGLES), F.ceil(F.count("*") / VISITORS)).cast("int").alias("parts")
    parts = members.groupBy("home").agg(parts).join(shares, "home")
    # a grid of parts: each has a share of the members and a share of the visitors
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = members.join(parts, "home").select("home", "node", "shares", F.pmod(F.hash("node"), F.col("parts")).alias("of"), each("shares").alias("share"))
    calls = calls.join(parts, "home").select("home", "node", "shares", each("parts").alias("of"), F.pmod(F.hash("node"), F.col("shares")).alias("share"))
    place = (F.col("of") * F.col("shares") + F.col("share")).alias("part")
    here, calls = (df.select("home", place, F.lit(role).alias("role"), "node") for role, df in enumerate((here, calls)))
    roles = here.unionByName(calls).join(settled, "node", "left").withColumn("component", F.coalesce("component", "node"))
    roles = checkpointed(roles)
    placed = possible_rows(docs, roles.select("node")).join(roles, F.col("doc_id") == F.col("node"))
    ordered = placed.repartition("home", "part").sortWithinPartitions("home", "part", "role")
    percent, shingle = settings.percent, settings.shingle

    def run(batches):
        shingler, group, index = Shingler(shingle), None, None
        held: list[tuple[int, int, np.ndarray]] = []
        for batch in batches:
            linked: list[tuple[int, int]] = []
            columns = [batch.column(c) for c in ("home", "part", "role", "node", "component", "text")]
            for k in range(batch.num_rows):
                home, part, role, node, component, text = (c[k].as_py() for c in columns)
                if group != (home, part):
                    group, index, held = (home, part), None, []
                own = shingler.set_of(text)
                if role == 0:
                    held.append((node, component, own))
                elif held:
                    index = index or _Home([h[2] for h in held], [h[1] for h in held])
                    linked += [(node, held[m][0]) for m in index.links(own, component, percent)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in linked], pa.int64()) for i in (0, 1)], ["a", "b"])

    return ordered.select("home", "part", "role", "node", "component", "text").mapInArrow(run, "a long, b long").distinct()


def handed_on(labels: DataFrame) -> DataFrame:
    """``node`` and ``component``: every node takes over the label of its label, and a label without one labels itself."""
    of = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
    moved = labels.join(of, "component", "left").select("node", F.coalesce("further", "component").alias("component"))
    tops = labels.select(F.col("component").alias("node")).distinct().join(labels, "node", "left_anti")
    return checkpointed(moved.unionByName(tops.withColumn("component", F.col("node"))))


def joined_labels(settled: DataFrame, links: DataFrame) -> DataFrame:
    """``settled`` after every label was replaced by the least label that its nodes are linked with, and that by its own."""
    a, b = (settled.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")) for end in ("a", "b"))
    pairs = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y")).filter("x <> y")
    least = checkpointed(pairs.select(F.greatest("x", "y").alias("component"), F.least("x", "y").alias("lower")).groupBy("component").agg(F.min("lower").alias("lower")))
    onward = least.select(F.col("component").alias("lower"), F.col("lower").alias("lowest"))
    again = least.join(onward, "lower", "left").select("component", F.coalesce("lowest", "lower").alias("lower"))
    alone = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(settled, "node", "left_anti").withColumn("component", F.col("node"))
    every = settled.select("node", "component").unionByName(alone.select("node", "component")).join(again, "component", "left")
    return checkpointed(every.select("node", F.coalesce("lower", "component").alias("component")))


def near_duplicates(df: DataFrame, settings: Settings = Settings(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    made = checkpointed(signatures(docs, settings))
    named = made.filter("digest is not null and doc_id is not null")
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")]
    nodes = checkpointed(named.groupBy("digest").agg(F.min("doc_id").alias("node"), *first))
    placed = nodes.select(F.explode("bands").alias("key"), "node")
    buckets = placed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).filter("centre < last")
    shared = checkpointed(placed.join(buckets.select("key", "centre"), "key"))
    homes = checkpointed(shared.groupBy("node").agg(F.min("centre").alias("home")))
    shared = checkpointed(shared.select("key", "node").join(homes, "node"))
    first_pairs = homes.filter("node <> home").select(F.col("home").alias("a"), F.col("node").alias("b"))
    release(df.sparkSession)
    linked = checkpointed(confirmed(docs, first_pairs, settings))
    release(df.sparkSession)
    settled = handed_on(linked.select(F.col("b").alias("node"), F.col("a").alias("component")))
    offered = checkpointed(_across(shared, nodes, settled, settings, visits=False).join(first_pairs, ["a", "b"], "left_anti"))
    release(df.sparkSession)
    links = checkpointed(linked.unionByName(confirmed(docs, offered, settings)))
    release(df.sparkSession)
    settled = joined_labels(settled, links)
    visits = checkpointed(_across(shared, nodes, settled, settings, visits=True))
    release(df.sparkSession)
    links = checkpointed(links.unionByName(_visited(docs, nodes, homes, settled, visits, settings)))
    release(df.sparkSession)
    # labels are reachable nodes, so their stars shorten the paths of the search
    stars = settled.select(F.col("node").alias("a"), F.col("component").alias("b"))
    settled = components(links.unionByName(stars))
    classes = nodes.select("digest", "node").join(settled, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    rows = made.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(df: DataFrame, settings: Settings = Settings(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stand for their group, all columns unchanged.

    Of rows that repeat an id (or have none) with the same text one stays, that whose other columns hash lowest. Rows of one id with
    different texts go or stay together. Columns must not be maps, which have no hash.
    """
    gone = near_duplicates(df, settings, text, doc_id).filter("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = packed(df).withColumn("id", F.col(f"row.`{doc_id}`").cast("long")).withColumn("body", F.col(f"row.`{text}`"))
    again = rows.select("id", F.xxhash64("body").alias("hash")).groupBy("id", "hash").agg(F.count("*").alias("n")).filter("n > 1")
    stay = rows.join(gone, F.col("id") == F.col("gone_id"), "left_anti")
    tried = may_hold(stay, F.xxhash64("id", F.xxhash64("body")), checkpointed(again), F.xxhash64("id", "hash"), "maybe")
    once = tried.filter("maybe").withColumn("draw", F.xxhash64("row")).groupBy("id", "body").agg(F.min_by("row", "draw").alias("row"))
    return tried.filter("not maybe").select("row").unionByName(once.select("row")).select("row.*")
