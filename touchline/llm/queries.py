"""One registered query per operator over the given tables, and its SQL statement where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import audit, bpe, html_text, lexical, licenses, minhash, mixing, ordinal, pii, quality_rules, secrets, simhash, warc
from touchline.llm.common import checkpointed, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The key of the test tables' surrogates. Of real data it is a secret that the caller keeps.
SURROGATE_KEY = "surrogates of the test tables"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query("""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM rep) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(t, '[^\\p{L}]+', '', 'g')) AS n_letters, length(t) - length(replace(t, '!', '')) AS n_exclaims
  FROM w LEFT JOIN ln ON w.doc_id = ln.doc_id LEFT JOIN cov ON w.doc_id = cov.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
       OR 2 * n_letters < word_chars OR 2 * n_exclaims > n_words) AS kept
FROM m
""")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements and verdict of every document."""
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected(F.col("failed"), "base").alias("base_failed"),
        (~quality_rules.rejected(F.col("failed"), "standard-1")).alias("kept"),
    )


@query("""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix-1:' || md5(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT source, sum(size) AS source_size FROM d GROUP BY source
), p AS (
  SELECT source, source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s
), r AS (
  SELECT *, coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight,
    sum(source_size) OVER () AS total
  FROM p WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), lv AS (
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM r)
), cut AS (
  SELECT k, CAST(total - 3 * stopped AS BIGINT) AS left_over, CAST(open_weight AS BIGINT) AS open_weight FROM lv
  WHERE CAST(CAST(weight * (total - 3 * stopped) AS BIGINT) AS DOUBLE) / open_weight <= 3 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN lv.k >= cut.k THEN CAST(CAST(weight * left_over AS BIGINT) AS DOUBLE) / cut.open_weight
      ELSE CAST(CAST(3 * source_size AS BIGINT) AS DOUBLE) END AS target
  FROM lv, cut
), q AS (
  SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS cumulative
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, coalesce(CAST(CAST(copy * source_size + cumulative AS BIGINT) AS DOUBLE) / nullif(target, 0), 0) AS finish
  FROM q, (SELECT unnest([0, 1, 2]) AS copy)
), m AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, copy, h, doc_id ROWS UNBOUNDED PRECEDING) AS running FROM c
)
SELECT doc_id, size, source_size, target,
  CAST(sum(CASE WHEN running <= (SELECT sum(size) FROM d) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM m GROUP BY doc_id, size, source_size, target
""")
def op5_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    each = mix.withColumn("row", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


@query()
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and linked credential parts of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query()
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query()
def op3_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    path = tokenizer_path()
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    ids = ids.select("doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    return bpe.decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text and their likeness; ``class_id`` is the least id with the same fingerprint.
    Ids divisible by 100 are searched among all: ``near_classes`` lists the classes within the radius, ``n_within`` counts their rows."""
    pairs = simhash.with_next(table(spark, sf_dir, "documents"))
    marks = checkpointed(pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "next_fingerprint"))
    found = simhash.within_radius(marks, marks.filter(F.col("doc_id") % 100 == 0))
    other = F.when(F.col("near") != F.col("fingerprint"), F.col("near_id"))
    near = found.groupBy("fingerprint").agg(F.sort_array(F.collect_list(other)).alias("near_classes"), (F.sum("rows") - 1).alias("n_within"))
    # a fingerprint may be that of a third of all rows: its rows meet copies of what is known of it
    known = simhash.classes(marks).join(near, "fingerprint", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    rows = marks.withColumn("salt", F.pmod(F.hash("doc_id", "edited_sha256"), F.lit(16))).join(known, ["fingerprint", "salt"])
    like = lambda other: simhash.likeness(simhash.distance(F.col("fingerprint"), F.col(other)))
    asked = lambda c: F.when(F.col("doc_id") % 100 == 0, F.col(c)).alias(c)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        like("edited_fingerprint").alias("near_edited"), like("next_fingerprint").alias("near_next"), "class_id", asked("near_classes"), asked("n_within"))


@query("""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = w.doc_id
""")
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: three-word shingles, 85 per cent."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.STRICT)


@query()
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detected licenses of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


@query()
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced, and the number of replacements."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, SURROGATE_KEY, count="n_replaced")


@query()
def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document, learned from the labels: 0 poor text, 1 toxic, 2 clean."""
    labels = table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rated = labels.select("doc_id", grade.alias("grade"))
    docs = table(spark, sf_dir, "documents")
    model = ordinal.fit(docs, rated, grades=3)
    scored = ordinal.score(docs, model)
    return scored.select("doc_id", "expected_grade", F.get("tails", F.lit(1)).alias("p_clean"), (F.get("tails", F.lit(1)) >= 0.5).alias("kept"))


@query("""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND payload_bytes >= 100
""")
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record, found through the capture index and read back from its archive."""
    pages, folder = table(spark, sf_dir, "pages"), shared_folder(spark, "warc")
    index = warc.build_index(warc.write(pages, folder), folder)
    records = warc.fetch(warc.find(index, pages, page_id="page_id"), index)
    number = lambda c: F.col(c).cast("long").alias("page_id" if c == "id" else c)
    return records.select(number("id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


@query("""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), z AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) SEMI JOIN q USING (term) GROUP BY r, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, z GROUP BY term, n_docs
), s AS (
  SELECT item_id, d.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ws) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN d ON d.r = t.r, z GROUP BY item_id, d.r, doc_id
), k AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
""")
def op12_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10).drop("scored")


@query("""
WITH f AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    coalesce(min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id, false) AS repeated
  FROM documents
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    CAST(len(ws) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INT)
      + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INT)
      + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(repeated AS INT) AS mask
  FROM f LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id) l ON l.doc_id = f.doc_id
), c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad FROM m GROUP BY part, mask
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b
), o AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5
), s AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(n_good) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS good_lost,
    coalesce(sum(n_bad) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every order of the five filters keeps, removes and loses, step by step and source by source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
