import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchline.functions import dates, json, numbers, text


def one(spark, column, value=None, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Jun&#039;ai Byfield", "jun ai byfield"), ("Sávio", "savio"), ("Ødegård", "odegard"), ("Đorđe Łoś", "dorde los"),
        ("Groß", "gross"), (" N'Golo  Kanté ", " n golo kante "), ("Ægir", "aegir"), (None, None),
    ],
)
def test_normalize_name(spark, raw, expected):
    assert one(spark, text.normalize_name("v"), raw) == expected


@pytest.mark.parametrize("raw, expected", [("GK S", "Goalkeeper"), ("D C", "Defence"), ("M", "Midfield"), ("F S", "Offence"), ("S", None), (None, None)])
def test_position(spark, raw, expected):
    assert one(spark, text.normalize_position("v"), raw) == expected


def test_trigram_similarity(spark):
    assert round(one(spark, text.similarity("v", F.lit("two words")), "word"), 4) == 0.3636
    assert one(spark, text.similarity("v", F.lit("!!")), "--") == 0.0
    assert one(spark, text.similarity("v", F.lit("ARSENAL fc")), "Arsenal FC") == 1.0


def test_exact_threshold_passes_as_float(spark):
    assert one(spark, F.lit(0.3).cast("float").cast("double") > F.lit(0.3)) is True


@pytest.mark.parametrize("raw, expected", [("-", 0), (None, 0), ("7", 7)])
def test_sentinel_int(spark, raw, expected):
    assert one(spark, numbers.sentinel_int("v"), raw) == expected


def test_sentinel_int_rejects_text(spark):
    with pytest.raises(Exception):
        one(spark, numbers.sentinel_int("v"), "12.0")


def test_per90(spark):
    assert one(spark, numbers.per90(F.lit("1.5").cast("decimal(20,10)"), "v"), 0, "int") is None
    assert one(spark, numbers.per90(F.lit("1.5").cast("decimal(20,10)"), "v"), 270, "int") == Decimal("0.500")
    assert one(spark, numbers.per90(F.lit("0.01").cast("decimal(20,10)"), "v"), 40, "int") == Decimal("0.023")


def test_token_cost(spark):
    cost = numbers.token_cost(F.lit(1000), F.lit(500), F.lit(2.0), F.lit(None).cast("double"))
    assert one(spark, cost) == 0.002


@pytest.mark.parametrize(
    "born, today, age",
    [("2002-02-28", "2024-02-28", 22), ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-06-15", "2024-06-14", 23), (None, "2024-01-01", None)],
)
def test_age(spark, born, today, age):
    assert one(spark, dates.age_years(F.col("v").cast("date"), F.lit(today).cast("date")), born) == age


@pytest.mark.parametrize(
    "name, league, season",
    [
        ("PL_2025_120000_000001.json", "premier-league", "2025-2026"), ("EPL_2025-2026_1_2.json", "premier-league", "2025-2026"),
        ("Ligue_1_2024_1_2.json", "ligue-1", "2024-2025"), ("FL1_2023.json", "ligue-1", "2023-2024"), ("BL1_2023_1.json", None, None),
        ("PL_latest_1.json", "premier-league", None),
    ],
)
def test_file_name(spark, name, league, season):
    assert one(spark, dates.file_league("v"), name) == league
    assert one(spark, dates.normalize_season(dates.file_season_token("v")), name) == season


def test_wall_clock_ignores_offset(spark):
    assert one(spark, dates.wall_clock("v"), "2025-08-16T14:00:00Z") == dt.datetime(2025, 8, 16, 14)
    assert one(spark, dates.wall_clock("v"), "2025-08-16T14:00:00+05:00") == dt.datetime(2025, 8, 16, 14)


def test_hash_ignores_key_order_and_blanks(spark):
    a = one(spark, json.canonical_hash("v"), '{"a": 1, "b": {"d": [1, 2], "c": null}}')
    b = one(spark, json.canonical_hash("v"), '{"b":{"c":null,"d":[1,2]},"a":1}')
    c = one(spark, json.canonical_hash("v"), '{"b":{"c":null,"d":[2,1]},"a":1}')
    assert a == b != c
    assert one(spark, json.canonical_hash("v"), "{broken") is None


def test_form_letters_and_suffix(spark):
    assert one(spark, text.form_letters("v", ["W", "D", "L"]), "W,D?L") == ["W", "D", "L"]
    assert one(spark, numbers.strip_signed_suffix("v"), "70.2+3.1") == "70.2"
