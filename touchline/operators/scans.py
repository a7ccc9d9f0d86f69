"""Ordered scans per key that never gather an oversized key in one task (W4-W6, K10), and interval joins.

The table is thought of as sorted by key and order and cut at evenly spaced places, as a range partitioning would be. A key that
holds at least two of these places is *heavy* and is scanned in parts between its places; every other key is scanned as a whole.
What the earlier parts of a heavy key contribute is one carry row per part. The places come from a sample of fixed size, and are
full order tuples, tie-breaks included, so rows level on the leading columns are spread like others. Places and carries are at
most one row per place each and are joined without a shuffle; the rows themselves are shuffled once, by key and part. Nothing
depends on how the caller's times or values are spread, and the plan is the same for every input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import with_one_row
from touchline.operators.lineage import cut_lineage

#: Sampled rows per place, as Spark's own range partitioning takes them.
SAMPLES = 20
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, 0)


def falling(*names: str) -> list[Column]:
    """Sort values of numeric columns in falling order, NULLs last."""
    return [v for n in names for v in (F.col(f"`{n}`").isNull(), -F.col(f"`{n}`"))]


def _same(a: DataFrame, b: DataFrame, columns: Mapping[str, str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[v]) for k, v in columns.items()], F.lit(True))


def _default_places(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sort_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """``keys`` with texts last: a sort compares the start of its first key before anything else, and few texts differ there."""
    types = dict(df.dtypes)
    return sorted(keys, key=lambda k: types[k] in ("string", "boolean"))


def key_places(df: DataFrame, keys: Sequence[str], order: Column, places: int | None = None) -> DataFrame:
    """Heavy keys (as ``_k0``, ``_k1`` ...) with the sorted order tuples ``_cuts`` they are cut at; at most ``places`` in all."""
    places = places or _default_places(df)
    named = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    columns = [f"_k{i}" for i in range(len(keys))]
    drawn = df.withColumn("_draw", F.xxhash64(F.monotonically_increasing_id())).orderBy("_draw").limit(places * SAMPLES)
    # order tuples are formed for the drawn rows only
    sample = drawn.select(*named, order.alias("_order"))
    # a window over the sample only: its size is fixed
    ranked = sample.withColumn("_at", F.row_number().over(Window.orderBy(*columns, "_order")))
    chosen = ranked.filter(F.col("_at") % SAMPLES == 0).groupBy(*columns)
    cuts = chosen.agg(F.sort_array(F.collect_set("_order")).alias("_cuts"), F.count(F.lit(1)).alias("_n"))
    return cut_lineage(cuts.filter("_n >= 2").drop("_n"))


def _with_parts(
    df: DataFrame, keys: Sequence[str], order: Column, cuts: DataFrame, places: int | None = None, how: str = "left"
) -> DataFrame:
    """``df`` with the number ``_part`` of the part of its key that a row lies in, NULL for keys that are not cut.

    With ``how="inner"`` only rows of cut keys: where no key is cut, the join is empty at once and ``df`` is not read.
    """
    on = _same(df, cuts, {k: f"_k{i}" for i, k in enumerate(keys)})
    joined = df.withColumn("_order", order).join(F.broadcast(cuts), on, how).withColumn("_part", F.lit(0))
    # bisection: the number of places below the row, from its highest binary digit down
    for digit in reversed(range((places or _default_places(df)).bit_length())):
        below = F.get("_cuts", F.col("_part") + (2**digit - 1)) < F.col("_order")
        joined = joined.withColumn("_part", F.col("_part") + F.when(below, 2**digit).otherwise(0))
    joined = joined.withColumn("_part", F.when(F.col("_cuts").isNotNull(), F.col("_part")))
    return joined.drop("_cuts", "_order", *[f"_k{i}" for i in range(len(keys))])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, str] | None = None,
    row_number: str | None = None,
    places: int | None = None,
) -> DataFrame:
    """Running sums ``{output: input}`` and the running row number of each key.

    Same result as ``sum(x) over (partition by keys order by order rows unbounded preceding)``, including NULL until the first
    non-NULL input. ``order`` lists ascending sort values, NULLs first; a descending number is its negative. ``df`` is read
    twice more, for the sample and for the totals of heavy keys: pass a materialised table.
    """
    sums = dict(sums or {})
    steps = {f"_m{i}": F.col(f"`{c}`") for i, c in enumerate(sums.values())}
    steps["_n"] = F.lit(1).cast("bigint")
    position = F.struct(*order)
    measured, keys = df.withColumns(steps), _sort_first(df, keys)
    cuts = key_places(df, keys, position, places)
    rows = _with_parts(measured, keys, position, cuts, places)
    heavy = _with_parts(measured, keys, position, cuts, places, "inner")
    totals = heavy.groupBy(*keys, "_part").agg(*[F.sum(m).alias(m) for m in steps])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(*_BEFORE)
    carry = totals.select(
        *[F.col(f"`{k}`").alias(f"_c{i}") for i, k in enumerate(keys)], F.col("_part").alias("_cp"),
        *[F.sum(m).over(before).alias(f"_b{m}") for m in steps],
    )
    # by the values themselves: they are quicker to compare than tuples, and need not be shuffled
    scan = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(*_UP_TO)
    within = rows.withColumns({m: F.sum(m).over(scan) for m in steps})
    on = _same(within, carry, {**{k: f"_c{i}" for i, k in enumerate(keys)}, "_part": "_cp"})
    joined = within.join(F.broadcast(carry), on, "left")

    def total(m: str) -> Column:
        return F.when(F.col(m).isNull(), F.col(f"_b{m}")).otherwise(F.coalesce(F.col(f"_b{m}"), F.lit(0)) + F.col(m))

    outputs = {name: total(m) for name, m in zip(sums, steps)}
    if row_number:
        outputs[row_number] = total("_n")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs], *[c.alias(name) for name, c in outputs.items()])


def rank_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "position", places: int | None = None
) -> DataFrame:
    """Row number of each key's rows in ``order`` (ascending values, the last of them unique within a key)."""
    return running_totals(df, keys, order, row_number=rank_col, places=places)


def as_of_join(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    probe_time: str,
    fact_time: str,
    tie_break: Sequence[str] = (),
    places: int | None = None,
) -> DataFrame:
    """Every probe with the latest fact of its key at ``fact_time <= probe_time`` (NULLs if none).

    ``tie_break`` orders facts of one time, the largest wins. Facts without a time are never met. Linear in probes + facts: no
    pair of a probe and a fact is formed.
    """
    payload, keys = [c for c in facts.columns if c not in keys], _sort_first(facts, keys)
    moved = facts.filter(F.col(fact_time).isNotNull()).select(
        *keys,
        F.struct(F.col(fact_time).alias("t"), F.lit(1).alias("kind"), F.struct(F.col(fact_time), *tie_break).alias("tie")).alias("_at"),
        F.struct(*payload).alias("_fact"),
    )
    no_tie = F.lit(None).cast(moved.schema["_at"].dataType["tie"].dataType)
    # facts come before probes of the same instant
    asked = probes.select(
        *keys, F.struct(F.col(probe_time).alias("t"), F.lit(2).alias("kind"), no_tie.alias("tie")).alias("_at"),
        F.struct(*[F.col(f"`{c}`") for c in probes.columns if c not in keys]).alias("_probe"),
    )
    stacked = moved.unionByName(asked, allowMissingColumns=True)
    cuts = key_places(stacked.select(*keys, "_at"), keys, F.col("_at"), places)
    rows = _with_parts(stacked, keys, F.col("_at"), cuts, places)
    names = [f"_k{i}" for i in range(len(keys))]
    heavy = _with_parts(moved, keys, F.col("_at"), cuts, places, "inner")
    last = heavy.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], "_part")
    last = last.agg(F.max_by("_fact", "_at").alias("_fact"))
    parts = cuts.select(*names, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_part"))
    filled = parts.alias("p").join(last.alias("l"), _same(parts, last, {c: c for c in (*names, "_part")}), "left")
    before = Window.partitionBy(*[F.col(f"p.{n}") for n in names]).orderBy("p._part").rowsBetween(*_BEFORE)
    carry = filled.select(
        *[F.col(f"p.{n}").alias(f"_c{i}") for i, n in enumerate(names)], F.col("p._part").alias("_cp"),
        F.last("l._fact", ignorenulls=True).over(before).alias("_carried"),
    )
    scan = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(*_UP_TO)
    within = rows.withColumn("_fact", F.last("_fact", ignorenulls=True).over(scan)).filter("_probe is not null")
    on = _same(within, carry, {**{k: f"_c{i}" for i, k in enumerate(keys)}, "_part": "_cp"})
    found = within.join(F.broadcast(carry), on, "left").withColumn("_fact", F.coalesce("_fact", "_carried"))
    asked_for = [F.col(f"`{c}`") if c in keys else F.col("_probe")[c].alias(c) for c in probes.columns]
    return found.select(*asked_for, *[F.col("_fact")[c].alias(c) for c in payload])


def bin_digits(length: Column) -> Column:
    """Binary digits of the length of the bins for versions of ``length`` microseconds: 0, 2, 6, 10 ..."""
    digits = F.when(length == 1, 0).otherwise(F.length(F.bin(length - 1)))
    return F.greatest(F.lit(0), F.shiftright(digits + 3, 2) * 4 - 2)


def valid_at_join(
    probes: DataFrame, history: DataFrame, keys: Sequence[str], probe_time: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Every probe with each version of its key valid at the probe time, overlapping versions included.

    Bins are 1, 4, 64, 1024 ... microseconds long, each length 16 times the one before, and a version lies in the bins of the one
    length that is at least a quarter and less than four times its own: five bins at most. A probe lies in one bin of every
    length that occurs (17 at most, three for versions of hours to decades), so it is copied few times however lengths vary.
    Bins are matched by an equi join, the interval by an exact check; at least a fifth of its bins belongs to a version, so
    candidates stay proportional to matches for versions that probes are spread over. A version without end is taken to reach the last probe.
    Probes without a valid version are dropped, as in an inner interval join.
    """
    payload = [c for c in history.columns if c not in keys]
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    asked = probes.withColumn("_t", micros(probe_time)).filter("_t is not null")
    last = asked.agg((F.max("_t") + 1).alias("_last"))
    versions = with_one_row(history.withColumns({"_from": micros(valid_from), "_to": micros(valid_to)}), last)
    versions = versions.withColumn("_end", F.least(F.coalesce("_to", "_last"), F.col("_last"))).filter("_from < _end")
    versions = versions.withColumn("_level", bin_digits(F.col("_end") - F.col("_from")))
    bins = F.sequence(F.expr("shiftright(_from, _level)"), F.expr("shiftright(_end - 1, _level)"))
    binned = versions.select(*keys, "_level", F.explode(bins).alias("_bin"), "_from", "_end", F.struct(*payload).alias("_version"))
    levels = versions.agg(F.collect_set("_level").alias("_levels"))
    each = with_one_row(asked, levels).withColumn("_level", F.explode("_levels")).withColumn("_bin", F.expr("shiftright(_t, _level)"))
    met = each.drop("_levels").join(binned, [*keys, "_level", "_bin"]).filter("_from <= _t and _t < _end")
    return met.select(*probes.columns, *[F.col("_version")[c].alias(c) for c in payload])
