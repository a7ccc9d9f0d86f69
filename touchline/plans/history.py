"""Type-2 history (H1-H3)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.plans.silver import STANDING_COLUMNS

STANDING_KEYS = ["league", "season", "team_id"]


def empty_history(current: DataFrame, keys: Sequence[str], check_cols: Sequence[str]) -> DataFrame:
    """A history without rows for the given current table."""
    return current.filter(F.lit(False)).select(
        *keys, *check_cols, F.lit(None).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def scd2_changes(
    opened: DataFrame, current: DataFrame, keys: Sequence[str], check_cols: Sequence[str], run_ts: Column
) -> DataFrame:
    """What one run at ``run_ts`` makes of the open versions: those it closes, and all that are open afterwards.

    A changed row closes its open version and opens a new one, a new key opens one, everything
    else stays, including keys that vanished. One full outer join of open versions with current rows.
    """
    old = opened.select(F.struct(*keys, *check_cols, "valid_from").alias("old"))
    fresh = current.select(F.struct(*keys, *check_cols).alias("new"))
    same_key = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    pairs = old.join(fresh, same_key, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & differs
    cols = [*keys, *check_cols]
    kept = F.when(
        F.col("old").isNotNull(),
        F.struct(
            *[F.col(f"old.{c}").alias(c) for c in cols],
            F.col("old.valid_from").alias("valid_from"),
            F.when(changed, run_ts).alias("valid_to"),
        ),
    )
    started = F.when(
        F.col("old").isNull() | changed,
        F.struct(
            *[F.col(f"new.{c}").alias(c) for c in cols],
            run_ts.alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
        ),
    )
    return pairs.select(F.explode(F.array_compact(F.array(kept, started))).alias("v")).select("v.*")


def scd2_snapshot(
    history: DataFrame, current: DataFrame, keys: Sequence[str], check_cols: Sequence[str], run_ts: Column
) -> DataFrame:
    """H1: the history after one run at ``run_ts``; closed versions pass through unshuffled.

    ``touchline.streaming.history`` keeps a history on storage without rewriting the closed part.
    """
    versions = scd2_changes(history.filter("valid_to is null"), current, keys, check_cols, run_ts)
    closed = history.filter("valid_to is not null").select(*keys, *check_cols, "valid_from", "valid_to")
    return closed.unionByName(versions)


def standings_snapshot(history: DataFrame, standings: DataFrame, run_ts: Column) -> DataFrame:
    """H1 over the standings columns."""
    return scd2_snapshot(history, standings, STANDING_KEYS, STANDING_COLUMNS, run_ts)


def scd2_replay(
    snapshots: DataFrame, keys: Sequence[str], check_cols: Sequence[str], run_col: str
) -> DataFrame:
    """H1 over many recorded runs at once: same rows as one ``scd2_snapshot`` per run.

    ``snapshots`` holds at most one row per key and run. A version starts where a check column
    differs from the key's previous run and ends where the next one starts.
    """
    by_run = Window.partitionBy(*keys).orderBy(run_col)
    state = F.struct(*check_cols)
    starts = (
        snapshots.withColumns({"_prev": F.lag(state).over(by_run), "_nth": F.row_number().over(by_run)})
        .filter((F.col("_nth") == 1) | ~F.col("_prev").eqNullSafe(state))
        .drop("_prev", "_nth")
    )
    return starts.select(
        *keys, *check_cols, F.col(run_col).alias("valid_from"), F.lead(run_col).over(by_run).alias("valid_to")
    )


def as_of_history(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at one moment."""
    return history.filter(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    )


def open_row_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """H3: keys with more than one open version."""
    counts = history.filter("valid_to is null").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")
