"""Per-key picks and ranks.

``row_number() <= k`` is planned with a map-side group limit, so at most k rows per key and map
task are shuffled: a key that holds a third of the table does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their rank."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(spec)).filter(F.col(rank_col) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (give a total order for a stable pick)."""
    return topk_per_key(df, keys, order, 1, "_rn").drop("_rn")


def pick_by_priority(df: DataFrame, keys: Sequence[str], priority: str, ties: Sequence[Column] = ()) -> DataFrame:
    """The candidate with the lowest priority number per key."""
    return latest_per_key(df, keys, [F.col(priority).asc_nulls_last(), *ties])


def unique_name_index(df: DataFrame, name: Column, id_col: str, out_name: str = "norm_name") -> DataFrame:
    """Names that belong to exactly one row, with that row's id; shared names are dropped."""
    return (
        df.groupBy(name.alias(out_name))
        .agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == 1)
        .drop("_n")
    )


def top_n(df: DataFrame, order: Sequence[Column], limit: int, max_limit: int | None = None) -> DataFrame:
    """L1: ordered head; a limit outside 1 to ``max_limit`` is refused."""
    if limit < 1 or max_limit is not None and limit > max_limit:
        raise ValueError(f"limit {limit} is not between 1 and {max_limit}")
    return df.orderBy(*order).limit(limit)
