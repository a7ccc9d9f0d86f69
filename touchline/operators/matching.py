"""Text matching joins: substring (K12) and trigram similarity.

Both are equi joins on character grams followed by an exact check, so no query is compared with
every name. A query looks up only its rarest grams, which keeps frequent grams out of the join;
heavy grams that remain are ordinary skewed equi keys, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import gram_similarity, trigrams, unaccent
from touchline.operators.joins import with_one_row
from touchline.operators.ranking import topk_per_key

GRAM_SIZES = (3, 2, 1)


def _char_grams(c: Column, size: int) -> Column:
    count = F.length(c) - F.lit(size - 1)
    return F.when(
        count >= 1,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: c.substr(i, F.lit(size)))),
    ).otherwise(F.array().cast("array<string>"))


def _like_pattern(folded: Column) -> Column:
    """Contains-pattern of a user text: its own wildcards stay active, stray escapes are dropped."""
    return F.concat(F.lit("%"), F.regexp_replace(folded, r"(?s)(\\[%_\\])|\\(.)", "$1$2"), F.lit("%"))


#: Stand-ins for escaped characters of a pattern while it is cut at its wildcards (private use area).
_ESCAPED = (("%", "\ue000"), ("_", "\ue001"), ("\\", "\ue002"))


def _literal_runs(folded: Column) -> Column:
    """The literal text between a pattern's wildcards; escaped wildcards and backslashes are literal, so is one at the very end."""
    marked = F.when(folded.rlike(r"(?s)^(?:[^\\]|\\.)*\\$"), F.concat(folded, F.lit("%"))).otherwise(folded)
    for plain, stand_in in reversed(_ESCAPED):
        marked = F.replace(marked, F.lit("\\" + plain), F.lit(stand_in))
    marked = F.replace(marked, F.lit("\\"), F.lit(""))
    runs = F.split(marked, "[%_]")

    def restored(run: Column) -> Column:
        for plain, stand_in in _ESCAPED:
            run = F.replace(run, F.lit(stand_in), F.lit(plain))
        return run

    return F.filter(F.transform(runs, restored), lambda r: r != "")


def _probe_grams(folded: Column) -> Column:
    """Grams every match must contain: of the longest size that fits a literal run, none for a pattern of wildcards only."""
    runs = _literal_runs(folded)
    longest = F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0))
    out = F.array().cast("array<string>")
    for size in sorted(GRAM_SIZES):
        grams = F.array_distinct(F.flatten(F.transform(runs, lambda r: _char_grams(r, size))))
        out = F.when(longest >= size, grams).otherwise(out)
    return out


def _name_grams(folded: Column) -> Column:
    return F.concat(*[_char_grams(folded, s) for s in GRAM_SIZES])


def _with_frequency(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Attach each probe gram's frequency among the indexed names (0 when absent)."""
    wanted = probes.select("gram").distinct()
    freq = index.join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("_freq"))
    return probes.join(freq, "gram", "left").withColumn("_freq", F.coalesce("_freq", F.lit(0)))


def _long_enough(open_ended: DataFrame, known: DataFrame, first: int | None) -> DataFrame:
    """Names for patterns of wildcards only, which ask for a least length and nothing else.

    Patterns are answered by their number of single-character wildcards, once for each number that occurs. Names are sorted
    once, by length: with ``first`` only the first names of every length stay, and of these the first of all longer ones.
    """
    wanted = open_ended.select("_least").distinct()
    leasts = wanted.agg(F.collect_set("_least").alias("_leasts"))  # one row, one entry per number of wildcards
    sized = known.select("_n", "_fn", F.length("_fn").alias("_size"))
    if first is not None:
        sized = topk_per_key(sized, ["_size"], [F.col("_n").asc()], first).drop("rank")
    reached = F.filter("_leasts", lambda u: u <= F.col("_size"))
    answers = with_one_row(sized, leasts).select("_n", "_fn", F.explode(reached).alias("_least"))
    if first is not None:
        answers = topk_per_key(answers, ["_least"], [F.col("_n").asc()], first).drop("rank")
    return open_ended.select("_q", "_least").join(answers, "_least").select("_q", "_n")


def substring_join(queries: DataFrame, query: str, names: DataFrame, name: str, first: int | None = None) -> DataFrame:
    """Distinct ``(query, name)`` texts where the folded name contains the folded query.

    ``%`` and ``_`` inside a query keep their wildcard meaning. ``first`` keeps the first names of each query in name order.
    Works on distinct texts; join ids back afterwards, so copies of one text cost nothing here.
    """
    asked = queries.select(F.col(query).alias("_q")).filter("_q is not null").distinct()
    asked = asked.withColumn("_fq", F.lower(unaccent("_q")))
    known = names.select(F.col(name).alias("_n")).filter("_n is not null").distinct()
    known = known.withColumn("_fn", F.lower(unaccent("_n")))
    index = known.select("_n", "_fn", F.explode(_name_grams(F.col("_fn"))).alias("gram"))
    free = F.col("_fq").rlike("^[%_]*$")
    probes = asked.filter(~free).select("_q", "_fq", F.explode(_probe_grams(F.col("_fq"))).alias("gram"))
    ranked = _with_frequency(probes, index)
    chosen = ranked.groupBy("_q", "_fq").agg(F.min_by("gram", F.struct("_freq", "gram")).alias("gram"))
    plain = ~F.col("_fq").rlike(r"[%_\\]")
    hit = F.when(plain, F.col("_fn").contains(F.col("_fq"))).otherwise(F.expr("_fn like _pattern"))
    chosen = chosen.withColumn("_pattern", _like_pattern(F.col("_fq")))
    pairs = chosen.join(index, "gram").filter(hit).select("_q", "_n")
    if first is not None:
        pairs = topk_per_key(pairs, ["_q"], [F.col("_n").asc()], first).drop("rank")
    least = F.length("_fq") - F.length(F.replace("_fq", F.lit("_"), F.lit("")))
    pairs = pairs.unionByName(_long_enough(asked.filter(free).withColumn("_least", least), known, first))
    return pairs.select(F.col("_q").alias(query), F.col("_n").alias(name))


def similarity_join(queries: DataFrame, query: str, names: DataFrame, name: str, threshold: float) -> DataFrame:
    """Distinct ``(query, name, similarity)`` with trigram similarity above ``threshold``.

    A pair above the threshold shares at least ``ceil(threshold * |query grams|)`` grams, so it is
    found through any ``|grams| - needed + 1`` of them: only those rarest grams of the query are
    joined, and a pair is kept at its first shared one. Exact: nothing is sampled or capped.
    """
    asked = queries.select(F.col(query).alias("_q")).filter("_q is not null").distinct()
    asked = asked.withColumn("_qg", trigrams(F.lower(unaccent("_q"))))
    known = names.select(F.col(name).alias("_n")).filter("_n is not null").distinct()
    known = known.withColumn("_ng", trigrams(F.lower(unaccent("_n"))))
    index = known.select("_n", "_ng", F.explode("_ng").alias("gram"))
    ranked = _with_frequency(asked.select("_q", F.explode("_qg").alias("gram")), index)
    # grams of one query text: bounded by its length
    ordered = ranked.groupBy("_q").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_freq", "gram"))), lambda g: g["gram"]).alias("_qg")
    )
    needed = F.greatest(F.ceil(F.lit(threshold) * F.size("_qg") - F.lit(1e-6)), F.lit(1))
    prefix = F.slice("_qg", F.lit(1), (F.size("_qg") - needed + 1).cast("int"))
    probes = ordered.withColumn("_prefix", prefix).select("_q", "_qg", "_prefix", F.explode("_prefix").alias("gram"))
    first_shared = F.array_intersect("_prefix", "_ng")[0] == F.col("gram")
    score = gram_similarity(F.col("_qg"), F.col("_ng"))
    return (
        probes.join(index, "gram")
        .filter(first_shared)
        .withColumn("similarity", score)
        .filter(F.col("similarity").cast("double") > F.lit(float(threshold)))
        .select(F.col("_q").alias(query), F.col("_n").alias(name), "similarity")
    )
