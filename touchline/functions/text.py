"""Text column functions: accent folding, name normalisation, trigram similarity."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.constants import POSITION_PREFIXES

# Letters that do not decompose into a base letter plus marks.
LETTER_FOLDS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "SS", "Þ": "TH", "þ": "th",
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l",
    "ı": "i", "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "Ŋ": "N", "ŋ": "n",
}


@lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """(from, to) strings for ``translate``: accented Latin letters to their base letter."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c))
        base = LETTER_FOLDS.get(base, base)
        if len(base) == 1 and base.isascii() and base != char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def unaccent(c: Column | str) -> Column:
    """Fold accented Latin letters to ASCII (one ``translate`` plus the two-letter folds)."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.translate(c, *_accent_pairs())
    for letter, folded in LETTER_FOLDS.items():
        if len(folded) > 1:
            out = F.replace(out, F.lit(letter), F.lit(folded))
    # plain ASCII has one byte per character and needs no folding
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(out)


def unescape_apostrophe(c: Column | str) -> Column:
    """Numeric HTML apostrophe entity to the character."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(c, F.lit("&#039;"), F.lit("'"))


def normalize_name(c: Column | str) -> Column:
    """Unescape, fold accents, lower-case, squeeze every other run to one space (no trim)."""
    return F.regexp_replace(F.lower(unaccent(unescape_apostrophe(c))), "[^a-z0-9]+", " ")


def lower_trim(c: Column | str) -> Column:
    """P4."""
    return F.lower(F.trim(c))


def normalize_position(c: Column | str) -> Column:
    """First-position code to a position name, anything else to NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.when(c.rlike("^" + code), F.lit(name)) for code, name in POSITION_PREFIXES.items()])


def trigrams(c: Column | str) -> Column:
    """Distinct 3-grams of the lower-cased words, each padded with two blanks before and one after."""
    c = F.col(c) if isinstance(c, str) else c
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(grams))


def gram_similarity(a: Column, b: Column) -> Column:
    """Jaccard of two distinct gram arrays as a 4-byte float (0 when both are empty)."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(0.0)).otherwise(shared / union).cast("float")


def similarity(a: Column | str, b: Column | str) -> Column:
    """Trigram similarity of two texts."""
    return gram_similarity(trigrams(a), trigrams(b))


def form_letters(c: Column | str, letters: list[str]) -> Column:
    """A form string as an array of its known letters, in order."""
    return F.filter(F.split(c, ""), lambda x: x.isin(*letters))
