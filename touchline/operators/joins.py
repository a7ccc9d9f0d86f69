"""Join forms.

No side carries a broadcast hint: Spark broadcasts a side when its measured size allows and shuffles
(with adaptive skew splitting) when it does not. The only nested-loop joins are against one-row
aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_role(df: DataFrame, dim: DataFrame, key: str, dim_key: str, attrs: Mapping[str, str]) -> DataFrame:
    """K3: left join one role of a dimension, ``{output: attribute}``; call once per role."""
    side = dim.select(F.col(dim_key).alias("_k"), *[F.col(a).alias(out) for out, a in attrs.items()])
    return df.join(side, df[key] == side["_k"], "left").drop("_k")


def without(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no partner; ``on`` maps left to right columns."""
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    side = other.select(*[F.col(r).alias(f"_r_{l}") for l, r in pairs.items()])
    cond = [df[l] == side[f"_r_{l}"] for l in pairs]
    return df.join(side, cond, "left_anti")


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """three-valued ``key NOT IN (select other_key from other)``.

    Empty list: every row. A NULL in the list: no row. Otherwise rows with a non-NULL key and no
    partner. Built as an equi anti join plus a one-row count of the list, so the list itself is
    never forced to every executor.
    """
    listed = other.select(F.col(other_key).alias("_r"))
    facts = listed.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("_r").isNull()).alias("_nulls"))
    unmatched = df.join(listed, df[key] == listed["_r"], "left_anti").crossJoin(F.broadcast(facts))
    keep = (F.col("_rows") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())
    return unmatched.filter(keep).drop("_rows", "_nulls")


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """K8: attach a global aggregate (exactly one row) to every row."""
    return df.crossJoin(F.broadcast(one_row))


def first_match(df: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, Column], str]], out: str) -> DataFrame:
    """K9: resolve ``out`` through several lookups, the first non-NULL hit wins.

    Each lookup is ``(table, {table column: expression over df}, value column)`` with unique keys.
    """
    hits = []
    for i, (table, on, value) in enumerate(lookups):
        probe = {f"_p{i}_{c}": expr for c, expr in on.items()}
        df = df.withColumns(probe)
        side = table.select(*[F.col(c).alias(f"_k{i}_{c}") for c in on], F.col(value).alias(f"_v{i}"))
        cond = [df[f"_p{i}_{c}"] == side[f"_k{i}_{c}"] for c in on]
        df = df.join(side, cond, "left").drop(*probe, *[f"_k{i}_{c}" for c in on])
        hits.append(f"_v{i}")
    return df.withColumn(out, F.coalesce(*hits)).drop(*hits)


def unpivot_sides(df: DataFrame, shared: Sequence[str], sides: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per side from a single scan; every side gives the same output columns."""
    structs = [F.struct(*[c.alias(name) for name, c in side.items()]) for side in sides]
    return df.select(*shared, F.explode(F.array(*structs)).alias("_side")).select(*shared, "_side.*")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U2."""
    return a.unionByName(b).distinct()


def optional_filters(df: DataFrame, **values) -> DataFrame:
    """equality on each given column; an empty, zero or missing value means no filter."""
    for column, value in values.items():
        if value:
            df = df.filter(F.col(column) == value)
    return df
