"""Generic operators on the order tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import joins
from touchline.operators.ranking import latest_per_key, pick_by_priority, top_n, topk_per_key, unique_name_index
from touchline.operators.scans import as_of_join, falling, rank_within, running_totals, valid_at_join
from touchline.plans.reads import position_rank
from touchline.registry.base import query, table

_MONTH = lambda c: F.trunc(c.cast("date"), "month")
_DAY = lambda c: c.cast("date")


# --- per-key picks ----------------------------------------------------------

_NEWEST = "ORDER BY o_orderdate DESC, o_orderkey DESC"


@query("latest_per_key", f"SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey {_NEWEST}) AS rn FROM orders) WHERE rn = 1")
def latest_order(spark, sf):
    return latest_per_key(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("distinct_on", "SELECT DISTINCT ON (o_custkey, o_orderstatus) o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderstatus, o_totalprice DESC, o_orderkey")
def distinct_on(spark, sf):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    picked = latest_per_key(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], order)
    return picked.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query("topk_per_key", f"SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey {_NEWEST}) AS rank FROM orders) WHERE rank <= 5")
def topk(spark, sf):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    top = topk_per_key(table(spark, sf, "orders"), ["o_custkey"], order, 5)
    return top.select("o_custkey", "o_orderkey", F.col("rank").cast("bigint").alias("rank"))


@query("priority_pick", "SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def priority_pick(spark, sf):
    picked = pick_by_priority(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", [F.col("o_orderkey").asc()])
    return picked.select("o_custkey", "o_orderpriority", "o_orderkey")


@query("rank_within", "SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders")
def global_rank(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ranked = rank_within(orders, ["o_orderstatus"], [*falling("o_totalprice"), F.col("o_orderkey")])
    return ranked.select("o_orderkey", "o_orderstatus", "position")


@query("running_totals", """SELECT o_custkey, o_orderkey, row_number() OVER w AS n_orders,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w AS BIGINT) AS spent_cents
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running(spark, sf):
    orders = table(spark, sf, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    out = running_totals(orders, ["o_custkey"], order, {"spent_cents": "cents"}, "n_orders")
    return out.select("o_custkey", "o_orderkey", "n_orders", "spent_cents")


# --- aggregates -------------------------------------------------------------

@query("ordered_concat", f"SELECT o_custkey, string_agg(o_orderstatus, '' ORDER BY rn) AS form FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey {_NEWEST}) AS rn FROM orders) WHERE rn <= 5 GROUP BY o_custkey")
def ordered_concat(spark, sf):
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    last = topk_per_key(table(spark, sf, "orders"), ["o_custkey"], order, 5)
    return last.groupBy("o_custkey").agg(F.expr("listagg(o_orderstatus, '') within group (order by rank)").alias("form"))


@query("array_agg_distinct_desc", "SELECT o_orderpriority, array_to_string(list_sort(list(DISTINCT year(o_orderdate)), 'DESC'), ',') AS years FROM orders GROUP BY 1")
def array_agg_distinct_desc(spark, sf):
    years = F.sort_array(F.collect_set(F.year("o_orderdate")), asc=False)
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.array_join(years.cast("array<string>"), ",").alias("years"))


@query("conditional_sums", """SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_f,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 3 WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS points,
    min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, (2 * CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) + count(*)) // (2 * count(*)) AS mean_cents FROM orders GROUP BY 1""")
def conditional_sums(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(status == "F").alias("n_f"),
        F.sum(F.when(status == "F", 3).when(status == "O", 1).otherwise(0)).alias("points"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"),
        F.expr("(2 * sum(cast(round(o_totalprice * 100) as bigint)) + count(1)) div (2 * count(1))").alias("mean_cents"),
    )


@query("count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def count_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query("select_distinct", "SELECT DISTINCT p_name, p_type FROM part")
def select_distinct(spark, sf):
    return table(spark, sf, "part").select("p_name", "p_type").distinct()


@query("having_singletons", "SELECT norm_name, min(p_partkey) AS p_partkey FROM (SELECT p_name || ' ' || p_brand || ' ' || p_size AS norm_name, p_partkey FROM part) GROUP BY 1 HAVING count(*) = 1")
def having_singletons(spark, sf):
    name = F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string"))
    return unique_name_index(table(spark, sf, "part"), name, "p_partkey")


# --- joins ------------------------------------------------------------------

@query("inner_join", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey")
def inner_join(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, sf, "orders").join(c, "o_custkey").select("o_orderkey", "c_name", "o_totalprice")


@query("left_composite", """SELECT s.s_suppkey, s.s_nationkey, p.n FROM supplier s LEFT JOIN
    (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) p
    ON p.l_suppkey = s.s_suppkey AND p.l_returnflag = CASE WHEN s.s_acctbal > 0 THEN 'A' END""")
def left_composite(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    s = table(spark, sf, "supplier").withColumn("flag", F.when(F.col("s_acctbal") > 0, "A"))
    cond = (s["s_suppkey"] == counts["l_suppkey"]) & (s["flag"] == counts["l_returnflag"])
    return s.join(counts, cond, "left").select("s_suppkey", "s_nationkey", "n")


@query("role_join_twice", """SELECT l_orderkey, l_linenumber, l_extendedprice, s.n_name AS supplier_nation, c.n_name AS customer_nation FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation s ON s.n_nationkey = s_nationkey LEFT JOIN nation c ON c.n_nationkey = c_nationkey""")
def role_join_twice(spark, sf):
    nation = table(spark, sf, "nation")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = table(spark, sf, "lineitem").join(o, "l_orderkey").join(s, "l_suppkey")
    rows = joins.join_role(rows, nation, "s_nationkey", "n_nationkey", {"supplier_nation": "n_name"})
    rows = joins.join_role(rows, nation, "c_nationkey", "n_nationkey", {"customer_nation": "n_name"})
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", "supplier_nation", "customer_nation").withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint")
    )


@query("expr_key_join", "SELECT c_custkey, s_suppkey FROM customer LEFT JOIN supplier ON s_suppkey + 100 = c_custkey")
def expr_key_join(spark, sf):
    s = table(spark, sf, "supplier")
    return joins.first_match(
        table(spark, sf, "customer"), [(s, {"s_suppkey": F.col("c_custkey") - 100}, "s_suppkey")], "s_suppkey"
    ).select("c_custkey", "s_suppkey")


@query("coalesce_match", """WITH u AS (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY 1 HAVING count(*) = 1)
    SELECT e.event_id, coalesce(s.s_suppkey, c.c_custkey, p.p_partkey) AS matched
    FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id AND s.s_nationkey = CAST(e.value AS INTEGER) % 25
    LEFT JOIN customer c ON c.c_custkey = e.user_id + CASE WHEN e.event_type = 'click' THEN 100 END
    LEFT JOIN part p ON p.p_partkey = e.event_id""")
def coalesce_match(spark, sf):
    whole = F.rint("value").cast("int")
    return joins.first_match(
        table(spark, sf, "events"),
        [
            (table(spark, sf, "supplier"), {"s_suppkey": F.col("user_id"), "s_nationkey": whole % 25}, "s_suppkey"),
            (table(spark, sf, "customer"), {"c_custkey": F.col("user_id") + F.when(F.col("event_type") == "click", 100)}, "c_custkey"),
            (table(spark, sf, "part"), {"p_partkey": F.col("event_id")}, "p_partkey"),
        ],
        "matched",
    ).select("event_id", "matched")


@query("cross_one_row", "SELECT o_orderkey, o_orderdate = (SELECT max(o_orderdate) FROM orders) AS is_last FROM orders")
def cross_one_row(spark, sf):
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max("o_orderdate").alias("last"))
    return joins.with_one_row(orders, last).select("o_orderkey", (F.col("o_orderdate") == F.col("last")).alias("is_last"))


@query("anti_left_null", "SELECT c_custkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey + 100 WHERE o_orderkey IS NULL")
def anti_left_null(spark, sf):
    shifted = table(spark, sf, "customer").withColumn("sought", F.col("c_custkey") + 100)
    return joins.without(shifted, table(spark, sf, "orders"), {"sought": "o_custkey"}).select("c_custkey")


@query("anti_not_exists", "SELECT p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey + 100)")
def anti_not_exists(spark, sf):
    shifted = table(spark, sf, "part").withColumn("sought", F.col("p_partkey") + 100)
    return joins.without(shifted, table(spark, sf, "lineitem"), {"sought": "l_partkey"}).select("p_partkey")


@query("not_in_null_aware", """SELECT 'without null' AS list, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'with null', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey END FROM orders)
    UNION ALL SELECT 'empty', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 0)""")
def not_in_null_aware(spark, sf):
    c, o = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders")
    lists = {
        "without null": o.filter("o_orderstatus = 'F'").select("o_custkey"),
        "with null": o.select(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("o_custkey")),
        "empty": o.filter("o_totalprice < 0").select("o_custkey"),
    }
    parts = [joins.not_in(c, "c_custkey", l, "o_custkey").select(F.lit(n).alias("list"), "c_custkey") for n, l in lists.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("as_of_join", """SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_suppkey, l.l_shipdate, max(o.o_orderdate) AS o_orderdate,
    arg_max(o.o_orderkey, (o.o_orderdate, o.o_orderkey)) AS o_orderkey
    FROM (SELECT *, row_number() OVER () AS r FROM lineitem) l
    LEFT JOIN orders o ON o.o_custkey = l.l_suppkey AND o.o_orderdate <= l.l_shipdate 
    GROUP BY r, l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_suppkey, l.l_shipdate""")
def latest_as_of(spark, sf):
    probes = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice", "l_suppkey", "l_shipdate"
    )
    facts = table(spark, sf, "orders").select(F.col("o_custkey").alias("l_suppkey"), "o_orderdate", "o_orderkey")
    return as_of_join(probes, facts, ["l_suppkey"], "l_shipdate", "o_orderdate", ["o_orderkey"])


@query("interval_join", """WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
      CASE WHEN o_orderkey % 50 > 0 THEN o_orderdate + to_days(CAST(o_orderkey % 900 AS INTEGER)) END AS valid_to FROM orders)
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, o_orderkey, valid_from, valid_to FROM lineitem JOIN v
    ON o_custkey = l_suppkey AND valid_from <= l_shipdate AND (valid_to IS NULL OR valid_to > l_shipdate)""")
def interval_join(spark, sf):
    """Orders as versions of their customer that overlap; some are empty, some have no end."""
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 900).cast("int"))
    versions = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("l_suppkey"), "o_orderkey", F.col("o_orderdate").alias("valid_from"),
        F.when(F.col("o_orderkey") % 50 > 0, end).alias("valid_to"),
    )
    probes = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice", "l_suppkey", "l_shipdate"
    )
    return valid_at_join(probes, versions, ["l_suppkey"], "l_shipdate", "valid_from", "valid_to").drop("l_suppkey")


# --- set operations, order, filters ------------------------------------------

@query("union_all_sides", """SELECT l_orderkey, l_linenumber, 'supplier' AS side, l_suppkey AS id, l_quantity AS plus, l_tax AS minus FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'part', l_partkey, l_tax, l_quantity FROM lineitem""")
def union_all_sides(spark, sf):
    q, t = F.col("l_quantity"), F.col("l_tax")
    rows = table(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    return joins.unpivot_sides(rows, ["l_orderkey", "l_linenumber"], [
        {"side": F.lit("supplier"), "id": F.col("l_suppkey"), "plus": q, "minus": t},
        {"side": F.lit("part"), "id": F.col("l_partkey"), "plus": t, "minus": q},
    ])


@query("union_distinct", "SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def union_distinct(spark, sf):
    a = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return joins.union_distinct(a, table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")))


@query("expected_minus_present", "SELECT c_custkey, year(o_orderdate) AS y FROM customer, (SELECT DISTINCT o_orderdate FROM orders) GROUP BY 1, 2 EXCEPT SELECT o_custkey, year(o_orderdate) FROM orders")
def expected_minus_present(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("bigint").alias("y"))
    years = orders.select(F.col("y")).distinct()
    span = years.agg(F.collect_set("y").alias("ys"))  # one row, one entry per year
    wanted = joins.with_one_row(table(spark, sf, "customer").select("c_custkey"), span)
    wanted = wanted.select("c_custkey", F.explode("ys").alias("y"))
    return joins.without(wanted, orders, {"c_custkey": "o_custkey", "y": "y"})


@query("null_ordering_topn", """SELECT o_orderkey, stat FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS stat FROM orders)
    ORDER BY stat DESC NULLS LAST, o_orderkey LIMIT 50""")
def null_ordering_topn(spark, sf):
    stat = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", stat.alias("stat"))
    return top_n(rows, [F.col("stat").desc_nulls_last(), F.col("o_orderkey").asc()], 50)


@query("nulls_first_topn", """SELECT o_orderkey, stat FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS stat FROM orders)
    ORDER BY stat DESC NULLS FIRST, o_orderkey LIMIT 50""")
def nulls_first_topn(spark, sf):
    stat = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", stat.alias("stat"))
    return top_n(rows, [F.col("stat").desc_nulls_first(), F.col("o_orderkey").asc()], 50)


@query("case_order", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS place FROM customer""")
def case_order(spark, sf):
    seg = F.col("c_mktsegment")
    pos = F.when(seg == "BUILDING", "Goalkeeper").when(seg == "MACHINERY", "Defence").when(seg == "FURNITURE", "Midfield").when(seg == "HOUSEHOLD", "Offence")
    rows = table(spark, sf, "customer").withColumn("pos", pos)
    return rows.select("c_custkey", position_rank("pos").cast("bigint").alias("place")).orderBy("place", "c_custkey")


@query("optional_filters", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def optional_filters(spark, sf):
    rows = joins.optional_filters(table(spark, sf, "orders"), o_orderstatus="F", o_custkey=0, o_orderpriority="")
    return rows.select("o_orderkey", "o_custkey")


@query("predicate_forms", """SELECT o_orderkey, o_orderstatus NOT IN ('F', 'O') AS closed, nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F' AS differs,
    o_orderpriority LIKE '%,%' OR o_orderpriority LIKE '%-%' AS dashed, regexp_matches(o_orderpriority, '^[12]') AS urgent,
    o_orderdate <= DATE '1998-01-01' AS early FROM orders WHERE o_totalprice > 0 AND o_orderdate IS NOT NULL""")
def predicate_forms(spark, sf):
    o = table(spark, sf, "orders").filter((F.col("o_totalprice") > 0) & F.col("o_orderdate").isNotNull())
    p = F.col("o_orderpriority")
    return o.select(
        "o_orderkey", (~F.col("o_orderstatus").isin("F", "O")).alias("closed"),
        (~F.nullif(F.col("o_orderstatus"), F.lit("P")).eqNullSafe(F.lit("F"))).alias("differs"),
        (p.contains(",") | p.contains("-")).alias("dashed"), p.rlike("^[12]").alias("urgent"),
        (F.col("o_orderdate") <= F.lit("1998-01-01").cast("date")).alias("early"),
    )
