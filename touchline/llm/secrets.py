"""Secret scans with multipart credential linking.

Single patterns find what is a secret by itself: assignments to a password-like name, access key ids and long hex runs. A
credential often comes in parts, an access identifier, a secret and an endpoint, each too weak to report alone. Weak parts
are linked inside a scope (parts of one document at most ``SCOPE`` code points apart, or in one block of several lines without
a blank line between them) and reported only where complementary parts co-occur there.

Positions come from splitting the text at the pattern: the lengths of pieces and matches add up to offsets. The linking is an
interval join on (document, offset) done as one ordered pass per document: the nearest part of each kind before and after a
weak part decides, so the work is n log n in the parts however densely they lie. Texts are scanned in place and never
shuffled; only documents with weak parts of two kinds send their parts through a shuffle.

Null and empty texts have no spans. Repeated rows get equal results. Rows are told apart by id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import let, matches

#: Code points between two linked parts at most, unless they lie in one block; what parts blocks.
SCOPE = 200
BLANK = r"\n[ \t\r\n]*\n"


def either_case(pattern: str) -> str:
    """Each ASCII letter outside a class as a class of both its cases (an (?i) flag folds further letters in some engines)."""
    out, inside = [], False
    for c in pattern:
        inside = c == "[" or inside and c != "]"
        out.append(f"[{c.upper()}{c.lower()}]" if c.isalpha() and not inside else c)
    return "".join(out)


_QUOTED = """["']?[ ]*[:=][ ]*["']?"""
ASSIGN = f"({either_case('password|passwd|secret|token|api_?key')}){_QUOTED}([A-Za-z0-9+/_.=-]+)"
#: A failing assignment still uses up its text, so its length is tested afterwards; the others match the same with it inside.
ASSIGN_LEAST = 6
BASE = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
#: Weak parts, reported only when linked.
WEAK = {
    "weak_id": f"({either_case('username|user|login|client_?id|account')}){_QUOTED}[A-Za-z0-9@+/_.-]{{3,}}",
    "weak_secret": f"({either_case('pwd|passphrase|auth_?key|private_?key|credential')}){_QUOTED}[A-Za-z0-9@!?+/_.=-]{{6,}}",
    "endpoint": "[a-z][a-z0-9+]{2,12}://[A-Za-z0-9_.-]+[A-Za-z0-9_./:-]*",
}
KINDS = [*BASE, *WEAK]
#: What each kind contributes to a credential, and of which other roles one must lie in scope for a weak part to be reported.
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "weak_id": "identifier", "weak_secret": "secret", "endpoint": "endpoint"}
NEEDS = {"weak_id": ["secret"], "weak_secret": ["identifier", "endpoint"], "endpoint": ["secret"]}
_SPAN = "array<struct<start:int,rank:int,stop:int>>"


def _has_sign(text: Column) -> Column:
    """Assignments and endpoints have one of these signs; looking for them first spares most texts the patterns."""
    return text.contains(":") | text.contains("=")


def _spans(text: Column, kind: str) -> Column:
    """Matches of a kind as structs (start, rank of the kind, stop)."""
    found = matches(text, (BASE | WEAK)[kind])
    if kind not in ("access", "hex"):
        found = F.when(_has_sign(text), found).otherwise(F.array().cast("array<struct<start:int,stop:int,value:string>>"))
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["stop"].alias("stop")))


def parts(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``), and per kind an array column of its spans."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(*[F.col(f"`{c}`") for c in keep or ["doc_id"]], *[_spans(t, kind).alias(f"found_{kind}") for kind in KINDS])


def _all(kinds: list[str]) -> Column:
    return F.array_sort(F.concat(*[F.col(f"found_{k}") for k in kinds]))


def _blocks(text: Column) -> Column:
    """Blocks of several lines without a blank line, as spans of rank -1."""
    def build(pieces: Column) -> Column:
        block = lambda blanks, p, i: F.struct(
            F.coalesce(F.get(blanks, i - 1)["stop"], F.lit(0)).alias("start"), F.lit(-1).alias("rank"),
            F.when(p.contains("\n"), F.coalesce(F.get(blanks, i)["start"], F.length(text))).alias("stop"))
        return let(matches(text, BLANK), lambda blanks: F.transform(pieces, lambda p, i: block(blanks, p, i)))

    return F.filter(let(F.split(text, BLANK, -1), build), lambda b: b["stop"].isNotNull())


def links(found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Weak parts with their complement in scope: ``doc_id``, ``content`` (hash of the text), ``linked`` (array of spans)."""
    secret = [k for k in KINDS if ROLES[k] == "secret"]
    others = [k for k in KINDS if ROLES[k] != "secret"]
    some = lambda kinds: sum((F.size(f"found_{k}") for k in kinds), F.lit(0)) > 0
    candidates = found.filter(some(secret) & some(others) & some(list(WEAK)))
    body = F.col(f"`{text}`")
    keyed = candidates.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("content"), F.concat(_all(KINDS), _blocks(body)).alias("parts"))
    rows = keyed.dropDuplicates(["doc_id", "content"]).select("doc_id", "content", F.explode("parts").alias("p")).select("doc_id", "content", "p.*")
    role = F.get(F.array(*[F.lit(ROLES[k]) for k in KINDS]), F.col("rank"))
    rows = rows.withColumn("role", role)
    by = W.partitionBy("doc_id", "content")
    before = by.orderBy("start", "rank").rowsBetween(W.unboundedPreceding, -1)
    after = by.orderBy(F.desc("start"), F.desc("rank")).rowsBetween(W.unboundedPreceding, -1)
    # the block that a part lies in: the last one that starts no later, if it ends no earlier
    so_far = by.orderBy("start", "rank").rowsBetween(W.unboundedPreceding, 0)
    opened, closed = (F.max(F.when(F.col("rank") == -1, F.col(c))).over(so_far) for c in ("start", "stop"))
    near = rows.withColumn("block_start", opened).withColumn("block_stop", closed)
    for r in ("identifier", "secret", "endpoint"):
        of_role = F.col("role") == r
        near = near.withColumn(f"gap_before_{r}", F.col("start") - F.max(F.when(of_role, F.col("stop"))).over(before))
        near = near.withColumn(f"gap_after_{r}", F.min(F.when(of_role, F.col("start"))).over(after) - F.col("stop"))
    # a gap that does not reach the border of the block stays inside it
    inside = F.col("block_stop") >= F.col("stop")
    reach = {"before": F.when(inside, F.col("start") - F.col("block_start") - 1), "after": F.when(inside, F.col("block_stop") - F.col("stop") - 1)}
    in_reach = lambda r, side: F.coalesce(F.col(f"gap_{side}_{r}") <= F.greatest(F.lit(SCOPE), reach[side]), F.lit(False))
    reported = F.lit(False)
    for kind, needs in NEEDS.items():
        for r in needs:
            reported = reported | ((F.col("rank") == KINDS.index(kind)) & (in_reach(r, "before") | in_reach(r, "after")))
    return near.filter(reported).groupBy("doc_id", "content").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "stop"))).alias("linked"))


def _text_of(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    named = F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(named, ",")


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, counts per base kind, ``base`` and ``spans`` as ``kind:start:end`` by start and kind, comma-joined."""
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = parts(docs, keep=["doc_id", "text"])
    linked = links(parts(docs.filter(_has_sign(F.col("text"))), keep=["doc_id", "text"])).select(F.col("doc_id").alias("id_of"), F.col("content").alias("content_of"), "linked")
    results = found.select(
        "doc_id",
        *[F.size(f"found_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        _all(list(BASE)).alias("base"),
        F.xxhash64("text").alias("content"),
    )
    joined = results.join(linked, F.col("doc_id").eqNullSafe(F.col("id_of")) & (F.col("content") == F.col("content_of")), "left")
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    return joined.select("doc_id", *[f"n_{k}" for k in BASE], _text_of(F.col("base")).alias("base"), _text_of(every).alias("spans"))
