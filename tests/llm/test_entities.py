"""Coreference, distinctness and valid check digits of surrogates; the pipeline's stages against plain Python."""

import re
from collections import Counter

import pytest

from tests.llm.test_llm import brute_components, repeat_words, words
from touchline.llm import mixing, pii

ROWS = "doc_id long, text string, source string, n_chars long, keep map<string,int>, row string, id string"


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(pii.pseudonymised(df, "k").collect(), key=lambda r: r.doc_id)]


def test_names_are_found_again_in_their_text_and_everywhere_else(spark):
    got = replaced(spark, [
        "Dr. Maria Lopez called. Later Lopez said Maria Lopez would sign; LopezCorp would not.",
        "Mr John wrote. Dr John wrote. John Peters wrote.", "Frau Maria Lopez und Mr John Peters.", "Lopez without an address stays.",
    ])
    given, surname = re.match(r"Dr\. (\S+) (\S+) called", got[0]).groups()
    assert got[0] == f"Dr. {given} {surname} called. Later {surname} said {given} {surname} would sign; LopezCorp would not."
    john = re.match(r"Mr (\S+) wrote", got[1])[1]
    assert got[1] == f"Mr {john} wrote. Dr {john} wrote. {john} Peters wrote."
    peters = re.search(r"(\S+)\.$", got[2])[1]
    assert got[2] == f"Frau {given} {surname} und Mr {john} {peters}." and len({given, surname, john, peters, "Maria", "Lopez", "John", "Peters"}) == 8
    assert got[3] == "Lopez without an address stays."


def test_only_valid_cards_and_valid_check_digits(spark):
    got = replaced(spark, ["order 1234567890123 and card 4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00 then GB82WEST12345698765432"])
    assert got[0].startswith("order 1234567890123 and card ") and "4111 1111 1111 1111" not in got[0]
    digits = [int(c) for c in reversed(re.sub(r"\D", "", got[0].split("card")[1]))]
    assert sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0
    for account in re.split(" then ", got[1]):
        plain = account.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and plain[:2] in ("DE", "GB")


def test_many_names_keep_apart(spark):
    names = [f"{a}{b}{c}" for a in "BCDFGHKLMN" for b in "aeiou" for c in ("la", "ma", "na", "ra", "sa", "ta", "va", "za")]
    found = spark.createDataFrame([(k, n.lower()) for n in names for k in ("surname", "given_f")], "kind string, norm string")
    rows = pii.surrogates(found, "k").collect()
    made = [r.new for r in rows]
    assert len(rows) == len(names) and len(set(made)) == len(made) and not set(made) & {n.lower() for n in names}


def test_a_count_column_that_exists_is_refused(spark):
    with pytest.raises(ValueError):
        pii.pseudonymised(spark.createDataFrame([(1, "x")], "n long, text string"), "k", count="n")


def rule_verdict(text):
    """Whether the standard policy keeps a text."""
    text, ws = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    letters, exclaims = sum(c.isalpha() for c in text), text.count("!")
    return not (
        len(ws) < 20 or 100 * repeat_words(ws) > 30 * len(ws) or len(re.findall(r"[#*$%&|<>]", text)) > len(ws)
        or 100 * (len(lines) - len(set(lines))) > 30 * len(lines) or 2 * letters < sum(map(len, ws)) or 2 * exclaims > len(ws))


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    long = lambda k, n: " ".join(f"word{(k * 31 + j * 7) % 500}x" for j in range(n))
    rows = [(k, long(k, 40 + k), f"s{k % 3}") for k in range(12)]
    rows += [(100, long(3, 43), "s1"), (101, long(3, 43) + " more", "s2"), (None, long(50, 30), None), (None, long(50, 30), None), (5, long(5, 45), "s2")]
    rows += [(200, None, "s0"), (201, "", None), (202, "too short", "s1"), (203, "again " * 60, "s1"), (204, long(60, 30) + " mail me@some.host now", "s0")]
    df = spark.createDataFrame([(i, t, s, 1, {"a": 1}, "r", "x") for i, t, s in rows], ROWS)
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: (str(r.doc_id), r.text or "", str(r.source))
    kept = stages["quality rules"](spark, df, "")
    assert kept.columns == df.columns
    first = [r for r in rows if rule_verdict(r[1])]
    assert Counter(map(key, kept.collect())) == Counter((str(i), t or "", str(s)) for i, t, s in first)
    plain = df.drop("keep")
    fewer = stages["near duplicates"](spark, stages["quality rules"](spark, plain, ""), "")
    groups = brute_components([(i, t) for i, t, _ in first if i is not None], 5, 80)
    wanted = {(i, t) for i, t, _ in first if i is None or groups[i][1] == i}
    assert fewer.columns == plain.columns and Counter((r.doc_id, r.text) for r in fewer.collect()) == Counter(wanted)
    fewer = spark.createDataFrame(fewer.collect(), plain.schema)
    clean = stages["personal data"](spark, fewer, "").collect()
    assert len(clean) == fewer.count() and all(r.n_chars == len(r.text) for r in clean)
    same = {r.doc_id: r.text for r in fewer.collect()}
    assert [r.doc_id for r in clean if r.text != same[r.doc_id]] == [204] and not any("me@some.host" in r.text for r in clean)
    clean = spark.createDataFrame(clean, plain.schema)
    mixed = stages["source mix"](spark, clean, "").collect()
    taken = {(r.doc_id, r.source): r.copies for r in mixing.mix(clean).collect()}
    assert Counter((r.doc_id, r.source) for r in mixed) == Counter({k: n for k, n in taken.items() if n})
    coded = stages["byte pairs"](spark, spark.createDataFrame(mixed, plain.schema), "").collect()
    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    texts = {(r.doc_id, r.source): r.text for r in mixed}
    for r in coded:
        ids = library.encode(texts[r.doc_id, r.source], add_special_tokens=False).ids
        assert r.exact and r.n_tokens == len(ids) and bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
    assert len(coded) == len(mixed)
    empty = plain.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0, name


def test_license_texts_without_a_name(spark):
    from touchline.llm import licenses

    texts = [
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\nassociated documentation files (the \"Software\"), to deal", "mit"),
        ("Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that", "bsd"),
        ("GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl,gpl-2"),
        ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for", "zlib"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
        ("Permission was granted to nobody.", ""),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: ",".join(r.labels) for r in licenses.scan(df).collect()}
    assert [got[k] for k in range(len(texts))] == [labels for _, labels in texts]
