"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements with one bit per failed rule. Which failures
count is a policy, a versioned mask: ``rejected`` compares two integers, and ``ablation`` replays any number of policies, and
each policy without any one of its rules, over counts per distinct mask. Neither reads a text again.

Everything happens inside a row, so there is no shuffle before the ablation, and that one sums per distinct mask on the map
side (at most 2^rules masks, however many documents there are).

Null or empty texts have no words and fail ``too_few_words``. Repeated rows are judged each for itself. A very long text is
handled in time n log n. Windows of words are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import WHITE, WORD, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Rule by bit: name and failure in terms of the measurements.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbol_heavy", "n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("few_letters", "2 * n_letters < word_chars"),
    ("long_words", "word_chars > 15 * n_words"),
    ("short_words", "2 * word_chars < 5 * n_words"),
    ("ellipsis", "10 * n_ellipses > n_words"),
    ("placeholder", "n_placeholders > 0"),
    ("shouting", "2 * n_exclaims > n_words"),
]
BITS = {name: 1 << k for k, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return reduce(lambda a, b: a | b, (BITS[n] for n in names), 0)


#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, int] = {
    "base": mask("too_few_words", "repeated_windows"),
    "standard-1": mask("too_few_words", "repeated_windows", "symbol_heavy", "duplicate_lines", "few_letters", "shouting"),
    "strict-1": mask(*BITS),
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_ellipses", "n_placeholders", "n_exclaims"]


def _windows(hashes: Column) -> Column:
    """Hashes of all windows of 8 words, from hashes of 2, 4 and 8 neighbours in turn."""
    pair = lambda h, step: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))
    eight = let(pair(hashes, 1), lambda two: let(pair(two, 2), lambda four: pair(four, 4)))
    return F.slice(eight, F.lit(1), F.size(hashes) - (WINDOW - 1))


def _repeat_words(w: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that occur twice or more among ``w``."""

    def covered(hashes: Column) -> Column:
        def marked(ordered: Column) -> Column:
            same = lambda x, k: (k >= 0) & F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
            repeated = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
            starts = F.array_sort(F.transform(repeated, lambda x: x["at"]))
            zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            step = lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last"))
            return F.aggregate(starts, zero, step)["n"]

        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(placed, marked)).otherwise(0)

    hashes = let(F.transform(w, lambda x: F.xxhash64(x)), _windows)
    return F.when(F.size(w) > WINDOW, let(hashes, covered)).otherwise(0)


def measures(text: Column) -> Column:
    """The measurements that the rules need as one struct of longs; a null text counts as empty."""
    t = F.coalesce(text, F.lit(""))
    of_words = let(words(t), lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    has_word = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD[:-1]))
    of_lines = let(has_word, lambda lines: F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines")))
    without = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    return F.struct(
        of_words.alias("of_words"),
        of_lines.alias("of_lines"),
        without(WHITE).alias("word_chars"),
        (F.length(t) - without(f"[{SYMBOLS}]+")).alias("n_symbols"),
        (F.length(t) - without("!+")).alias("n_exclaims"),
        without(r"\P{L}+").alias("n_letters"),
        F.regexp_count(t, F.lit(r"\.\.\.|…")).alias("n_ellipses"),
        F.regexp_count(F.lower(t), F.lit("lorem ipsum")).alias("n_placeholders"),
    )


def ledger(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``), every measurement, and ``failed`` with one bit per failed rule."""
    kept = [F.col(f"`{c}`").alias(f"keep_{k}") for k, c in enumerate(keep or ["doc_id"])]
    measured = df.select(*kept, measures(F.col(f"`{text}`")).alias("m"))
    place = {"n_words": "m.of_words.n_words", "n_repeat_words": "m.of_words.n_repeat_words", "n_lines": "m.of_lines.n_lines", "n_dup_lines": "m.of_lines.n_dup_lines"}
    helpers = [F.col(f"keep_{k}") for k in range(len(kept))]
    measured = measured.select(*helpers, *[F.col(place.get(name, f"m.{name}")).cast("long").alias(name) for name in MEASURES])
    bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES))
    named = [F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep or ["doc_id"])]
    return measured.select(*named, *MEASURES, bits.cast("long").alias("failed"))


def rejected(failed: Column, policy: str | int) -> Column:
    """Whether the policy, by name or as a mask, rejects a ledger row."""
    return failed.bitwiseAND(F.lit(POLICIES[policy] if isinstance(policy, str) else policy)) != 0


def accepted(df: DataFrame, policy: str = "standard-1", text: str = "text") -> DataFrame:
    """The rows of ``df`` that the policy keeps, all columns unchanged."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    judged = ledger(df.select(row, F.col(f"`{text}`").alias("text")), keep=["row"])
    return judged.filter(~rejected(F.col("failed"), policy)).select("row.*")


def ablation(ledger_rows: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """Per policy and left-out rule (null: none): documents kept, and documents that only this rule rejects.

    Works on counts per distinct mask, whose number the rules bound.
    """
    variants = [
        (policy, name, m, m & ~BITS[name] if name else m)
        for policy, m in (policies or POLICIES).items()
        for name in [None, *(n for n in BITS if m & BITS[n])]
    ]
    spark = ledger_rows.sparkSession
    replayed = spark.createDataFrame(variants, "policy string, without_rule string, full long, reduced long")
    masks = ledger_rows.groupBy("failed").agg(F.count("*").alias("n"))
    rejects = lambda m: F.col("failed").bitwiseAND(F.col(m)) != 0
    return (
        masks.join(F.broadcast(replayed))
        .groupBy("policy", "without_rule")
        .agg(
            F.sum(F.when(~rejects("reduced"), F.col("n")).otherwise(0)).alias("kept"),
            F.sum(F.when(rejects("full") & ~rejects("reduced"), F.col("n")).otherwise(0)).alias("rejected_by_rule_alone"),
        )
    )
