"""License scans by ordered signature rules behind a keyword prefilter.

A text is scanned for a handful of keywords first, by plain search in its lower-cased form and then by pattern; only texts with a
keyword meet that keyword's rules, and of these only the ones whose own literal the text holds. A rule is a regular expression with a label and a priority. Overlapping detections are resolved by containment: one that lies inside a detection
of higher priority, or of equal priority and larger extent, is dropped.

The rules are a fixed table of names times the forms in which licenses are stated, and of sentences of license texts and notices,
so the broadcast of rules has a fixed size. Each detection is a small row; containment is one ordered pass per text with a running maximum of ends, not a
comparison of pairs. Texts stay where they are read: rules meet them without a shuffle.

Null and empty texts have no words and no labels. Repeated rows get equal results. Texts are scanned whole whatever their length; an
empty table gives no rows; columns besides those named are not looked at.
"""

from __future__ import annotations

import re
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import let, spans, sums_before

#: Characters between words: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Phrases whose words must stand side by side, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label, keyword that a text must contain, pattern of the name (a blank stands for what may part words), SPDX id.
NAMES = [
    ("mit", "mit", "mit", "mit"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?,?(?: version)? v?2(?:.0)?", "apache-2.0"),
    ("apache-1.1", "apache", "apache(?: software)? license,?(?: version)? v?1.1", "apache-1.1"),
    ("apache-1", "apache", "apache(?: software)? license,?(?: version)? v?1.0", "apache-1.0"),
    ("gpl-2", "general public", "gnu general public license,?(?: version| v)? ?2(?:.0)?", "gpl-2.0(?:-only|-or-later)?"),
    ("gpl-3", "general public", "gnu general public license,?(?: version| v)? ?3(?:.0)?", "gpl-3.0(?:-only|-or-later)?"),
    ("gpl", "general public", "gnu general public license", "gpl"),
    ("gpl-2", "gpl", "(?:gnu )?gpl,?(?: version)? ?v?2(?:.0)?", "gpl-2.0+"),
    ("gpl-3", "gpl", "(?:gnu )?gpl,?(?: version)? ?v?3(?:.0)?", "gpl-3.0+"),
    ("lgpl-2.1", "lesser general", "gnu lesser general public license,?(?: version| v)? ?2.1", "lgpl-2.1(?:-only|-or-later)?"),
    ("lgpl-3", "lesser general", "gnu lesser general public license,?(?: version| v)? ?3(?:.0)?", "lgpl-3.0(?:-only|-or-later)?"),
    ("lgpl", "lesser general", "gnu lesser general public license", "lgpl"),
    ("lgpl-2", "library general", "gnu library general public license,?(?: version| v)? ?2(?:.0)?", "lgpl-2.0"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license,?(?: version| v)? ?3(?:.0)?", "agpl-3.0(?:-only|-or-later)?"),
    ("agpl", "affero", "(?:gnu )?affero general public license", "agpl"),
    ("bsd-2", "bsd", "(?:bsd[- ]2[- ]clause|2[- ]clause bsd|simplified bsd|freebsd)", "bsd-2-clause"),
    ("bsd-3", "bsd", "(?:bsd[- ]3[- ]clause|3[- ]clause bsd|new bsd|modified bsd|revised bsd)", "bsd-3-clause"),
    ("bsd-4", "bsd", "(?:bsd[- ]4[- ]clause|4[- ]clause bsd|original bsd|old bsd)", "bsd-4-clause"),
    ("bsd-0", "bsd", "(?:0bsd|bsd zero[- ]clause|zero[- ]clause bsd)", "0bsd"),
    ("bsd", "bsd", "bsd(?:[- ]style)?", "bsd"),
    ("mpl-1.1", "mozilla", "mozilla public license,?(?: version| v)? ?1.1", "mpl-1.1"),
    ("mpl-2", "mozilla", "mozilla public license,?(?: version| v)? ?2(?:.0)?", "mpl-2.0"),
    ("mpl", "mozilla", "mozilla public license", "mpl"),
    ("epl-1", "eclipse", "eclipse public license,?(?: version| v)? ?1(?:.0)?", "epl-1.0"),
    ("epl-2", "eclipse", "eclipse public license,?(?: version| v)? ?2(?:.0)?", "epl-2.0"),
    ("cddl-1", "distribution license", "common development and distribution license", "cddl-1.0"),
    ("cpl-1", "common public", "common public license", "cpl-1.0"),
    ("eupl-1.1", "european union", "european union public licen[cs]e,?(?: version| v)? ?1.1", "eupl-1.1"),
    ("eupl-1.2", "european union", "european union public licen[cs]e(?:,? ?(?:version|v)? ?1.2)?", "eupl-1.2"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?:/libpng)?", "zlib"),
    ("bsl-1", "boost", "boost software license(?:,? ?(?:version|v)? ?1.0)?", "bsl-1.0"),
    ("busl-1.1", "business source", "business source license(?:,? ?(?:version|v)? ?1.1)?", "busl-1.1"),
    ("sspl-1", "server side", "server side public license(?:,? ?(?:version|v)? ?1)?", "sspl-1.0"),
    ("elastic-2", "elastic", "elastic license,? ?(?:version|v)? ?2(?:.0)?", "elastic-2.0"),
    ("artistic-1", "artistic", "artistic license,? ?(?:version|v)? ?1(?:.0)?", "artistic-1.0"),
    ("artistic-2", "artistic", "artistic license,? ?(?:version|v)? ?2(?:.0)?", "artistic-2.0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "font license", "sil open font license(?:,? ?(?:version|v)? ?1.1)?", "ofl-1.1"),
    ("postgresql", "postgresql", "postgresql license", "postgresql"),
    ("php-3", "php", "php license(?:,? ?(?:version|v)? ?3(?:.01)?)?", "php-3.0(?:1)?"),
    ("psf-2", "python software", "python software foundation license(?: version 2)?", "psf-2.0"),
    ("ms-pl", "microsoft", "microsoft public license", "ms-pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms-rl"),
    ("odbl-1", "database license", "open (?:data commons open )?database license(?: v?1.0)?", "odbl-1.0"),
    ("odc-by-1", "attribution license", "open data commons attribution license", "odc-by-1.0"),
    ("pddl-1", "public domain dedication", "public domain dedication and license", "pddl-1.0"),
    ("cc0", "cc0", "cc0(?: 1.0)?(?: universal)?", "cc0-1.0"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1234].0)?", "cc-by-[1234].0"),
    ("cc-by-sa", "creative commons", "creative commons attribution[- ]share[- ]?alike(?: [1234].0)?", "cc-by-sa-[1234].0"),
    ("cc-by-nc", "creative commons", "creative commons attribution[- ]non[- ]?commercial(?: [1234].0)?", "cc-by-nc-[1234].0"),
    ("cc-by-nd", "creative commons", "creative commons attribution[- ]no[- ]?deriv(?:ative)?s?(?: [1234].0)?", "cc-by-nd-[1234].0"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike(?: [1234].0)?", "cc-by-nc-sa-[1234].0"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?deriv(?:ative)?s?(?: [1234].0)?", "cc-by-nc-nd-[1234].0"),
    ("cc-by", "cc by", "cc by(?: [1234].0)?", "cc by [1234].0"),
    ("cc-by-nc", "cc by", "cc by[- ]nc(?: [1234].0)?", "cc by nc [1234].0"),
    ("cc-by-sa", "cc by", "cc by[- ]sa(?: [1234].0)?", "cc by sa [1234].0"),
    ("cc-by-nd", "cc by", "cc by[- ]nd(?: [1234].0)?", "cc by nd [1234].0"),
    ("cc-by-nc-sa", "cc by", "cc by[- ]nc[- ]sa(?: [1234].0)?", "cc by nc sa [1234].0"),
    ("cc-by-nc-nd", "cc by", "cc by[- ]nc[- ]nd(?: [1234].0)?", "cc by nc nd [1234].0"),
    ("proprietary", "all rights reserved", "all rights reserved", "licenseref-proprietary"),
]
#: Forms in which a name states a license: priority, score, prefix and suffix. Bare names count only where they are unmistakable.
FORMS = [
    (3, 1.0, "spdx-license-identifier: ", ""),
    (2, 0.9, "(?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?", ""),
    (2, 0.9, "(?:under|subject to|according to) (?:the terms of )?the ", " licen[cs]e"),
    (1, 0.6, "", " licen[cs]e"),
]
#: Sentences of license texts and notices that name no license or no version: label, keyword, words in order (whatever stands between).
SIGNATURES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsl-1", "hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("x11", "x consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", "may(?: not)? be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2", "apache", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license"),
    ("gpl-2", "either version", "either version 2 of the license or(?: at your option)? any later version"),
    ("gpl-3", "either version", "either version 3 of the license or(?: at your option)? any later version"),
    ("lgpl-2.1", "either version", "either version 2.1 of the license or(?: at your option)? any later version"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("zlib", "held liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("cc0", "neighboring rights", "waived all copyright and related or neighboring rights"),
    ("epl-2", "eclipse", "made available under the terms of the eclipse public license 2.0"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "copying of this file", "unauthorized copying of this file via any medium is strictly prohibited"),
]
#: Names that state a license by themselves.
BARE = ("general public", "lesser general", "library general", "affero", "mozilla public", "eclipse public", "creative commons", "public license",
        "public licence", "software license", "font license", "all rights reserved", "database license", "cddl", "cc0", "wtfpl", "distribution license")
PRIORITIES = (1, 2, 3)


def _loose(pattern: str) -> str:
    """Blanks match any run of characters between words, a full stop in a version only itself."""
    return pattern.replace(".", r"\.").replace(" ?", f"{BETWEEN}*").replace("[- ]", f"{BETWEEN}+").replace(" ", f"{BETWEEN}+")


def _literal(pattern: str) -> str:
    """The longest run of letters that every match of ``pattern`` holds, whatever its alternatives and options."""
    plain = re.sub(r"\[[^\]]*\]\??", "|", pattern.replace("(?:", "("))
    while "(" in plain:
        plain = re.sub(r"\([^()]*\)\??", "|", plain)
    plain = re.sub(r".\?", "|", plain)
    return max(re.findall("[a-z]*", plain), key=len)


def rules() -> list[tuple[int, str, int, float, str, str, str]]:
    """Number, keyword, priority, score, label, pattern and literal of every rule."""
    found = []
    for label, keyword, name, spdx in NAMES:
        # a rule's keyword must lie in every text that its own pattern matches: SPDX ids need not contain the name's
        forms = [("spdx", p, s, before + spdx + after) if "spdx" in before else (keyword, p, s, before + name + after) for p, s, before, after in FORMS]
        if any(b in name or b in keyword for b in BARE):
            forms.append((keyword, 1, 0.6, name))
        for gate, priority, score, body in forms:
            found.append((gate, priority, score, label, f"(?i)(?<!{IN_WORD}){_loose(body)}(?!{IN_WORD})", _literal(body)))
    for label, keyword, words in SIGNATURES:
        found.append((keyword, 3, 1.0, label, f"(?i)(?<!{IN_WORD}){_loose(words)}(?!{IN_WORD})", _literal(words)))
    return [(k, *rule) for k, rule in enumerate(found)]


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rules(), "rule int, keyword string, priority int, score double, label string, pattern string, literal string")


KEYWORDS = sorted({rule[1] for rule in rules()})
#: Keywords that stand as whole words in everything their rules match, though they lie inside many other words.
_WORDS = ("mit", "isc")


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, as the patterns' own case folding takes it."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _held(low: Column) -> Column:
    """``keywords`` of a lower-cased text: words sought plainly rule nearly all patterns out."""

    def pattern(keyword: str) -> str:
        return f"{keyword}(?<!{IN_WORD}{keyword})(?!{IN_WORD})" if keyword in _WORDS else keyword.replace(" ", f"{BETWEEN}+")

    def held(keyword: str) -> Column:
        found = reduce(lambda a, b: a & b, [low.contains(w) for w in keyword.split()])
        return found if " " not in keyword and keyword not in _WORDS else found & low.rlike(pattern(keyword))

    return F.array_compact(F.array(*[F.when(held(k), F.lit(k)) for k in KEYWORDS]))


def keywords(text: Column) -> Column:
    """The rule keywords that ``text`` contains. Each is sought by itself, as one may lie inside another."""
    return let(lowered(text), _held)


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, f"{BETWEEN}+"), ""))


def phrase_starts(text: Column, phrase: str) -> Column:
    """Word numbers, from 0, at which the words of ``phrase`` stand side by side."""
    pattern = f"(?i)(?<!{IN_WORD})" + f"{BETWEEN}+".join(phrase.split()) + f"(?!{IN_WORD})"

    def starts(pieces: Column) -> Column:
        own = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: count_words(p))
        steps = let(own, lambda n: sums_before(F.transform(n, lambda x: x + len(phrase.split()))))
        return F.transform(F.arrays_zip(own.alias("own"), steps.alias("before")), lambda x: x["own"] + x["before"])

    none = F.array().cast("array<int>")
    return F.when(text.rlike(pattern), let(F.split(text, pattern, -1), starts)).otherwise(none)


def detections(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rule matches that no other match suppresses: ``doc_id``, ``content`` (hash of the text), label, score, start, stop."""
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("low", lowered(F.col("text")))
    gated = docs.withColumn("content", F.xxhash64("text")).withColumn("keyword", F.explode(_held(F.col("low"))))
    ruled = gated.join(F.broadcast(rule_table(df.sparkSession)), "keyword")
    matched = ruled.filter(F.expr("contains(low, literal) and text rlike pattern"))
    pieces = F.expr("split(text, pattern, -1)")
    # offsets as in common.matches, for a pattern that is a column
    placed = matched.select("doc_id", "content", "rule", "priority", "score", "label", "pattern", pieces.alias("pieces"), F.expr("regexp_extract_all(text, pattern, 0)").alias("found"))
    found = placed.select("doc_id", "content", "rule", "priority", "score", "label", F.explode(spans(F.col("pieces"), F.col("found"))).alias("s"))
    rows = found.select("doc_id", "content", "rule", "priority", "score", "label", "s.start", "s.stop").dropDuplicates(["doc_id", "content", "rule", "start", "stop"])
    before = W.partitionBy("doc_id", "content").orderBy("start", F.desc("stop"), F.desc("priority"), "rule").rowsBetween(W.unboundedPreceding, -1)
    # of matches with one extent the best comes first; a match that starts no later and ends no earlier contains this one
    contained = [(F.col("priority") <= p) & (F.max(F.when(F.col("priority") >= p, F.col("stop"))).over(before) >= F.col("stop")) for p in PRIORITIES]
    judged = rows.withColumn("inside", F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in contained]), F.lit(False)))
    return judged.filter("not inside").drop("inside")


def scan(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, the phrases' ``starts``, ``base_labels`` and all ``labels`` (sorted arrays), ``score``."""
    t = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    starts = {label: phrase_starts(t, phrase) for phrase, label in PHRASES.items()}
    scanned = docs.select("doc_id", F.xxhash64("text").alias("content"), count_words(t).cast("long").alias("n_words"), *[s.alias(f"at_{k}") for k, s in enumerate(starts.values())])
    labels = [F.when(F.size(f"at_{k}") > 0, F.lit(label)) for k, label in enumerate(starts)]
    based = scanned.select(
        "doc_id", "content", "n_words",
        F.array_sort(F.concat(*[F.col(f"at_{k}") for k in range(len(starts))])).alias("starts"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
    )
    found = detections(df, text, doc_id).groupBy(F.col("doc_id").alias("id_of"), F.col("content").alias("content_of")).agg(
        F.collect_set("label").alias("ruled"), F.max("score").alias("best"))
    joined = based.join(found, F.col("doc_id").eqNullSafe(F.col("id_of")) & (F.col("content") == F.col("content_of")), "left")
    return joined.select(
        "doc_id", "n_words", "starts", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("ruled", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(F.when(F.size("base_labels") > 0, 1.0).otherwise(0.0), F.coalesce("best", F.lit(0.0))).alias("score"),
    )
