"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import dates, numbers, text
from touchline.functions.json import json_field, url_parameter
from touchline.registry.base import query, table


@query("normalize_names", """SELECT doc_id, md5(regexp_replace(lower(replace(replace(strip_accents(replace(text, '&#039;', '''')), 'ß', 'ss'), 'ø', 'o')), '[^a-z0-9]+', ' ', 'g')) AS norm_md5 FROM documents""")
def normalize_names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(text.normalize_name("text")).alias("norm_md5"))


@query("unaccent_text", "SELECT conv_id, turn, replace(strip_accents(text), 'ß', 'ss') AS folded FROM conversations")
def unaccent_text(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.unaccent("text").alias("folded"))


@query("position_map", """SELECT p_partkey, CASE WHEN p_type LIKE 'M%' THEN 'Midfield' WHEN code LIKE 'GK%' THEN 'Goalkeeper' WHEN code LIKE 'D%' THEN 'Defence' WHEN code LIKE 'F%' THEN 'Offence' END AS position
    FROM (SELECT *, CASE p_type WHEN 'PROMO' THEN 'GK S' WHEN 'LARGE' THEN 'D C' WHEN 'SMALL' THEN 'F M' ELSE p_type END AS code FROM part)""")
def position_map(spark, sf):
    t = F.col("p_type")
    code = F.when(t == "PROMO", "GK S").when(t == "LARGE", "D C").when(t == "SMALL", "F M").otherwise(t)
    return table(spark, sf, "part").select("p_partkey", text.normalize_position(code).alias("position"))


@query("per90", """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN minutes > 0 THEN ((cents * 1800 + minutes) // (2 * minutes)) / 1000.0 END AS rate
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) - 1 AS minutes FROM lineitem)""")
def per90(spark, sf):
    rows = table(spark, sf, "lineitem")
    value = F.round(F.col("l_extendedprice") * 100).cast("decimal(20,0)") / F.lit(100)
    rate = numbers.per90(value, F.col("l_quantity").cast("bigint") - 1)
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice", rate.cast("double").alias("rate"))


@query("sentinel_int", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderkey % 31 ELSE 0 END AS goals FROM orders")
def sentinel_int(spark, sf):
    s = F.col("o_orderstatus")
    cell = F.when(s == "F", (F.col("o_orderkey") % 31).cast("string")).when(s == "O", "-")
    return table(spark, sf, "orders").select("o_orderkey", numbers.sentinel_int(cell).cast("bigint").alias("goals"))


@query("age_years", "SELECT o_orderkey, CAST(date_part('year', age(DATE '2024-02-28', CAST(o_orderdate AS DATE))) AS BIGINT) AS age FROM orders")
def age_years(spark, sf):
    age = dates.age_years(F.to_date("o_orderdate"), F.lit("2024-02-28").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", age.cast("bigint").alias("age"))


@query("season_text", "SELECT o_orderkey, year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS season, CAST(year(o_orderdate) AS VARCHAR) AS season_start FROM orders")
def season_text(spark, sf):
    y = F.year("o_orderdate").cast("string")
    token = F.when(F.col("o_orderstatus") == "F", y).otherwise(F.concat_ws("-", y, (F.year("o_orderdate") + 1).cast("string")))
    season = dates.normalize_season(token)
    return table(spark, sf, "orders").select("o_orderkey", season.alias("season"), dates.season_start(season).alias("season_start"))


@query("wall_clock", "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS utc_date, CAST(ts AS DATE) AS day FROM events")
def wall_clock(spark, sf):
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_type") == "click", "Z").otherwise("+05:00"))
    parsed = dates.wall_clock(stamp)
    return table(spark, sf, "events").select("event_id", parsed.alias("utc_date"), F.to_date(parsed).alias("day"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", json_field("props", "$.k", "bigint").alias("k"))


@query("url_param", """SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm FROM pages""")
def url_param(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_parameter("url", "page").alias("page"), url_parameter("url", "utm_source").alias("utm"))


@query("signed_suffix", "SELECT o_orderkey, regexp_extract(cell, '^([^+-]*)', 1) AS figure FROM (SELECT o_orderkey, o_custkey || '.' || o_orderstatus || CASE o_orderstatus WHEN 'F' THEN '+3.1' WHEN 'O' THEN '-0.2' ELSE '' END AS cell FROM orders)")
def signed_suffix(spark, sf):
    s = F.col("o_orderstatus")
    tail = F.when(s == "F", "+3.1").when(s == "O", "-0.2").otherwise("")
    cell = F.concat(F.col("o_custkey").cast("string"), F.lit("."), s, tail)
    return table(spark, sf, "orders").select("o_orderkey", numbers.strip_signed_suffix(cell).alias("figure"))


_SQL_GRAMS = """list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(strip_accents({c})), '[^a-z0-9]+'), lambda w: w <> ''),
    lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""


@query("similarity_rows", f"""WITH g AS (SELECT o.o_orderkey, {_SQL_GRAMS.format(c="c_name || ' ' || c_mktsegment")} AS a, {_SQL_GRAMS.format(c="o_orderpriority || ' ' || c_mktsegment")} AS b
      FROM orders o JOIN customer c ON c_custkey = o_custkey),
    s AS (SELECT *, len(list_intersect(a, b)) AS shared FROM g)
    SELECT o_orderkey, round(shared / (len(a) + len(b) - shared), 6) AS similarity FROM s""")
def similarity_rows(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = table(spark, sf, "orders").join(c, "o_custkey")
    score = text.similarity(F.concat_ws(" ", "c_name", "c_mktsegment"), F.concat_ws(" ", "o_orderpriority", "c_mktsegment"))
    return rows.select("o_orderkey", F.round(score.cast("double"), 6).alias("similarity"))


@query("html_unescape", "SELECT conv_id, turn, replace(role || '&#039;' || text, '&#039;', '''') AS plain, lower(trim('  ' || role || ' ')) AS role FROM conversations")
def html_unescape(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.unescape_apostrophe(F.concat("role", F.lit("&#039;"), "text")).alias("plain"),
        text.lower_trim(F.concat(F.lit("  "), "role", F.lit(" "))).alias("role"),
    )
