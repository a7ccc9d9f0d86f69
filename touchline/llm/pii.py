"""Personal data replaced by keyed surrogates.

Detected entities (mail addresses, account and card numbers, bank accounts, phone and social security numbers, IP addresses,
names after a form of address and wherever else the same text has them) get surrogates of their own type: digits keep their
places and separators, card numbers and bank accounts have valid check digits, names keep gender, script and case. A surrogate is a
keyed hash of the entity's normal form, so an entity has one surrogate in all documents (coreference) and the key is needed to link the
two. A name is one entity whether it was met as given name or surname, of the gender that any form of address gives it.
Distinctness is checked over the whole table: where two entities would share a surrogate, or a surrogate is itself an entity of the
data, a further attempt is made for the later one until no such case is left; names grow with every attempt, so there are always
more of them than entities.

Only distinct entities are shuffled for the checks. Texts without candidates pass through untouched; the others are shuffled
once, by content, to meet their surrogates. All steps are column expressions.

Null and empty texts stay as they are. Repeated rows get equal texts. The order of rows is not kept. Texts are matched whole whatever
their length; an empty table gives no rows; other columns, whatever their names, stay as they are. A number of 13 to 19 digits is a
card number only if its check digit fits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, let, matches, matches_of, packed

#: Attempts before the search for distinct surrogates gives up; only formats with fewer numbers than entities get there.
MAX_ATTEMPTS = 64

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_MAIL_CHAR = "[A-Za-z0-9._%+-]"
#: Kinds in order of preference where patterns match the same place.
PATTERNS = {
    "email": rf"(?<!{_MAIL_CHAR}){_MAIL_CHAR}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
             r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
UNION = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Forms of address by gender.
ADDRESS = {
    "m": "Mr|Mister|Sir|Herr|Herrn|Monsieur|Señor|Sr|Don|Господин|Κύριος",
    "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Doña|Госпожа|Κυρία",
    "n": "Dr|Prof|Professor|Doctor|Доктор",
}
_ANY_ADDRESS = "|".join(ADDRESS.values())
_NAME = r"\p{Lu}[\p{L}'’-]{1,30}"


def _name_pattern(address: str, last: bool) -> str:
    """A capitalised word among those that follow a form of address, taken whole: the last one, or one before it."""
    return rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{address})\.? (?:|{_NAME} |{_NAME} {_NAME} )){_NAME}+" + (rf"(?! \p{{Lu}}\p{{L}})" if last else rf"(?= \p{{Lu}}\p{{L}})")


NAME_PATTERNS = {f"given_{g}": _name_pattern(a, last=False) for g, a in ADDRESS.items()} | {"surname": _name_pattern(_ANY_ADDRESS, last=True)}
_CANDIDATE = rf"@|[0-9]{{3}}|[0-9]\.[0-9]|(?:{_ANY_ADDRESS})\.? \p{{Lu}}"
_NONE = "array<struct<start:int,stop:int,value:string,kind:string>>"

#: Syllables that names are made of, by script: beginnings, middles, and endings by gender (n: surnames and unknown).
SYLLABLES = {
    "latin": ("Al Be Car Da El Fen Gar Hel Is Jo Kar Li Mar Nor Ol Per Ro Sel Tor Vin", "ba da li mo na ri so ta ve lo", {"m": "n rd s t k", "f": "a ia ina elle ela", "n": "er sen man ton berg"}),
    "cyrillic": ("Ал Бо Вик Гле Да Ев Жан Зо Иг Ки Ле Мар Ник Ол Пав Ро Сер Та Фё Юл", "ба да ли мо на ри со та ве ло", {"m": "н р с т к", "f": "а ия ина ья ла", "n": "ко ук енко ич ян"}),
    "greek": ("Αλ Βα Γε Δη Ελ Ζη Θε Ιω Κα Λε Μα Νι Ξε Ορ Πα Ρο Σο Τη Φι Χα", "βα δα λι μο να ρι σο τα βε λο", {"m": "ς ος ης ας ων", "f": "α η ία ίνα ούλα", "n": "ίδης άκης ού ιάς έας"}),
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def entities(text: Column) -> Column:
    """Entities of a text in order, as structs ``start``, ``stop`` (code points), ``value``, ``kind``."""
    def kind_of(value: Column) -> Column:
        kind = F.lit("card")
        for name in reversed(list(PATTERNS)):
            kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
        return kind

    def of_kind(found: Column, kind) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), m["value"].alias("value"), kind(m["value"]).alias("kind")))

    numbers = of_kind(matches(text, UNION), kind_of)
    names = [of_kind(matches(text, pattern), lambda _, kind=kind: F.lit(kind)) for kind, pattern in NAME_PATTERNS.items()]
    addressed = F.when(text.rlike(rf"(?:{_ANY_ADDRESS})\.? \p{{Lu}}"), F.concat(*names)).otherwise(F.array().cast(_NONE))
    every = F.array_sort(F.concat(numbers, addressed))
    # of overlapping entities the first stays
    apart = lambda found: F.filter(found, lambda e, i: (i == 0) | (F.coalesce(F.get(found, i - 1)["stop"], F.lit(0)) <= e["start"]))
    valid = F.filter(apart(every), lambda e: (e["kind"] != "card") | (_luhn_sum(_digits(e["value"])) % 10 == 0))
    return let(valid, lambda found: _with_later_mentions(text, found, apart))


def _with_later_mentions(text: Column, found: Column, apart: Callable[[Column], Column]) -> Column:
    """``found`` and every other place of the text where one of its names stands as a word of its own."""
    names = F.filter(found, lambda e: e["kind"].isin(*NAME_PATTERNS))
    values = F.array_distinct(F.transform(names, lambda e: e["value"]))
    # names consist of letters, apostrophes and hyphens, so they are patterns of themselves
    pattern = F.concat(F.lit(r"(?<![\p{L}])(?:"), F.array_join(values, "|"), F.lit(r")(?![\p{L}])"))
    kind = lambda v: F.get(F.filter(names, lambda e: e["value"] == v), F.lit(0))["kind"]
    again = F.transform(matches_of(text, pattern), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), m["value"].alias("value"), kind(m["value"]).alias("kind")))
    fresh = F.filter(again, lambda e: ~F.exists(found, lambda f: (e["start"] < f["stop"]) & (f["start"] < e["stop"])))
    return F.when(F.size(names) > 0, let(F.array_sort(F.concat(found, fresh)), lambda merged: apart(merged))).otherwise(found)  # noqa: PLW0108


def normal(kind: Column, value: Column) -> Column:
    """What makes two mentions the same entity: digits (phone numbers: the last ten), or the text without case."""
    return (
        F.when(kind == "phone", F.when(F.length(_digits(value)) > 10, F.substring(_digits(value), -10, 10)).otherwise(_digits(value)))
        .when(kind.isin("card", "ssn"), _digits(value))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .otherwise(F.lower(value))
    )


def _luhn_sum(digits: Column) -> Column:
    """Luhn checksum of all digits, the last one counted as the check digit."""
    def part(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part), F.lit(0), lambda a, x: a + x)


def _pick(choices: str, seed: Column, at: int) -> Column:
    options = choices.split()
    place = F.conv(F.substring(seed, at, 6), 16, 10).cast("long") % len(options)
    return F.get(F.array(*map(F.lit, options)), place.cast("int"))


def _made_name(script: str, gender: str, seed: Column, attempt: Column) -> Column:
    """A name with two further syllables for every attempt."""
    starts, middles, endings = SYLLABLES[script]
    more = lambda i: let(F.sha2(F.concat(seed, i.cast("string")).cast("binary"), 256), lambda s: F.concat(_pick(middles, s, 1), _pick(middles, s, 7)))
    longer = F.when(attempt > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(attempt, F.lit(1))), more), "")).otherwise("")
    return F.lower(F.concat(_pick(starts, seed, 1), _pick(middles, seed, 7), longer, _pick(endings[gender], seed, 13)))


def _iban_rest(account: Column) -> Column:
    """The remainder modulo 97 of an account's characters, letters counted as 10 to 35."""
    place = lambda c: F.ascii(c) - F.when(c.rlike("[0-9]"), F.lit(48)).otherwise(F.lit(55))
    step = lambda m, c: (m * F.when(c.rlike("[0-9]"), 10).otherwise(100) + place(c)) % 97
    return F.aggregate(F.filter(F.split(account, ""), lambda c: c != ""), F.lit(0), step)


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The keyed surrogate of a normal form, itself a normal form."""
    family = F.when(kind.isin(*NAME_PATTERNS), F.lit("name")).otherwise(kind)
    seed = F.sha2(F.concat_ws("|", F.lit(key), family, norm, attempt.cast("string")).cast("binary"), 256)
    decimal = F.translate(seed, "abcdef", "012345")
    number = F.substring(decimal, F.lit(1), F.length(norm))
    valid = _luhn_sum(norm) % 10 == 0
    body = F.substring(decimal, F.lit(1), F.length(norm) - 1)
    check = (10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.when(valid, F.concat(body, check.cast("string"))).otherwise(number)
    octet = lambda k, low: (low + F.conv(F.substring(seed, 8 * k + 1, 6), 16, 10).cast("long") % (254 - low)).cast("string")
    letters = F.translate(F.sha2(seed.cast("binary"), 256), "0123456789", "ghijklmnop")
    local, host = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    site = F.concat(F.lit("mail-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), host).cast("binary"), 256), 1, 10), F.lit(".example.org"))
    more = F.when(attempt > 0, F.concat(F.lit("."), F.substring(seed, 1, 8))).otherwise("")
    like_local = F.array_join(F.transform(F.split(local, ""), lambda c, i: (
        F.when(c.rlike("[0-9]"), F.substring(decimal, (i % 60) + 1, F.lit(1)))
        .when(c.rlike("[a-z]"), F.substring(letters, (i % 60) + 1, F.lit(1))).otherwise(c))), "")
    country = F.substring(norm, 1, 2)
    account = F.array_join(F.transform(F.split(F.substring(norm, F.lit(5), F.length(norm)), ""), lambda c, i: (
        F.when(c.rlike("[0-9]"), F.substring(decimal, i + 1, F.lit(1))).otherwise(F.upper(F.substring(letters, i + 1, F.lit(1)))))), "")
    iban = F.concat(country, F.lpad((98 - _iban_rest(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    named = F.lit(None).cast("string")
    for script in SYLLABLES:
        in_script = F.lit(True) if script == "latin" else norm.rlike(rf"\p{{Is{script.capitalize()}}}")
        of_kind = F.when(kind == "given_m", _made_name(script, "m", seed, attempt)).when(kind == "given_f", _made_name(script, "f", seed, attempt)).otherwise(_made_name(script, "n", seed, attempt))
        named = F.when(in_script, of_kind) if script == "latin" else F.when(in_script, of_kind).otherwise(named)
    return (
        F.when(kind == "email", F.concat(like_local, more, F.lit("@"), site))
        .when(kind == "ip", F.concat_ws(".", octet(0, 1), octet(1, 0), octet(2, 0), octet(3, 1)))
        .when(kind == "card", card).when(kind.isin("phone", "ssn"), number).when(kind == "iban", iban).otherwise(named)
    )


def rendered(kind: Column, value: Column, new: Column) -> Column:
    """A surrogate in the format of the mention ``value``: separators, leading country code and case stay."""
    keep = F.length(_digits(value)) - F.length(new)
    at = lambda i: F.length(_digits(F.substring(value, F.lit(1), i)))
    placed = F.array_join(F.transform(F.split(value, ""), lambda c, i: (
        F.when(c.rlike("[0-9]") & (at(i) >= keep), F.substring(new, at(i) - keep + 1, F.lit(1))).otherwise(c))), "")
    before = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i), " ", ""))
    spaced = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substring(new, before(i) + 1, F.lit(1)))), "")
    cased = F.when(F.upper(value) == value, F.upper(new)).otherwise(F.initcap(new))
    return F.when(kind.isin("phone", "card", "ssn"), placed).when(kind == "iban", spaced).when(kind.isin(*NAME_PATTERNS), cased).otherwise(new)


def family(kind: Column) -> Column:
    """What keeps entities apart: their kind, and ``name`` for all kinds of names."""
    return F.when(kind.isin(*NAME_PATTERNS), F.lit("name")).otherwise(kind)


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """``family``, ``norm`` and ``new`` for the distinct entities of ``found``: no two share ``new``, and none is an entity itself."""
    # a name's kinds in the order given_f, given_m, given_n, surname: the first tells its gender
    table = found.groupBy(family(F.col("kind")).alias("family"), "norm").agg(F.min("kind").alias("kind")).withColumn("attempt", F.lit(0))
    table = checkpointed(table.withColumn("new", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)))
    real = table.select("family", F.col("norm").alias("new"), F.lit(True).alias("taken"))
    for _ in range(MAX_ATTEMPTS):
        order = W.partitionBy("family", "new").orderBy("attempt", "norm")
        judged = table.join(real, ["family", "new"], "left").withColumn("again", F.coalesce("taken", F.lit(False)) | (F.row_number().over(order) > 1))
        judged = checkpointed(judged.select("family", "kind", "norm", "attempt", "new", "again"))
        if judged.filter("again").isEmpty():
            return table.select("family", "norm", "new")
        attempt = F.when(F.col("again"), F.col("attempt") + 1).otherwise(F.col("attempt"))
        anew = F.when(F.col("again"), surrogate(F.col("kind"), F.col("norm"), F.col("attempt") + 1, key)).otherwise(F.col("new"))
        table = checkpointed(judged.select("family", "kind", "norm", attempt.alias("attempt"), anew.alias("new")))
    raise ValueError(f"entities left without a surrogate of their own after {MAX_ATTEMPTS} attempts")


def pseudonymised(df: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with personal data in ``text`` replaced under the secret ``key``; ``count`` names a further column for the number of
    replacements, which must not exist."""
    if count in df.columns:
        raise ValueError(f"the table has a column {count} already")
    row = packed(df).withColumn("body", F.col(f"row.`{text}`"))
    candidate = F.coalesce(F.col("body").rlike(_CANDIDATE), F.lit(False))
    found = row.filter(candidate).withColumn("spans", entities(F.col("body"))).withColumn("content", F.md5(F.col("body").cast("binary")))
    per_text = found.filter(F.size("spans") > 0).select("content", "spans").dropDuplicates(["content"])
    mentions = checkpointed(per_text.select("content", F.posexplode("spans").alias("at", "s")).select("content", "at", "s.value", "s.kind"))
    mentions = mentions.withColumn("norm", normal(F.col("kind"), F.col("value")))
    mentions = mentions.withColumn("family", family(F.col("kind")))
    replaced = mentions.join(surrogates(mentions, key), ["family", "norm"]).withColumn("shown", rendered(F.col("kind"), F.col("value"), F.col("new")))
    lists = replaced.groupBy(F.col("content").alias("of")).agg(F.array_sort(F.collect_list(F.struct("at", "shown"))).alias("new"))
    joined = found.join(lists, F.col("content") == F.col("of"), "left")
    cut = lambda spans, i: F.coalesce(F.get(spans, i - 1)["stop"], F.lit(0))
    spans, body = F.col("spans"), F.col("body")
    # get() beyond either end is null: before the first entity the text starts at 0
    pieces = F.transform(F.col("new"), lambda n, i: F.concat(
        F.substring(body, F.when(i == 0, 0).otherwise(cut(spans, i)) + 1, F.get(spans, i)["start"] - F.when(i == 0, 0).otherwise(cut(spans, i))), n["shown"]))
    tail = F.substring(body, F.element_at(spans, -1)["stop"] + 1, F.length(body))
    rebuilt = F.when(F.col("new").isNull(), body).otherwise(F.concat(F.array_join(pieces, ""), tail))
    changed = joined.select(F.col("row").withField(text, rebuilt).alias("row"), F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n"))
    same = row.filter(~candidate).select("row", F.lit(0).cast("long").alias("n"))
    every = changed.unionByName(same)
    return every.select("row.*", F.col("n").alias(count)) if count else every.select("row.*")
