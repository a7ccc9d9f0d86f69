"""Data-quality checks (DQ1-DQ14): every check is a DataFrame of violating rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.constants import (
    EXPECTED_COMBOS, FRESHNESS_ERROR_DAYS, FRESHNESS_WARN_DAYS, SECONDARY, TERTIARY,
)
from touchline.functions.text import normalize_name
from touchline.operators.joins import not_in, without
from touchline.plans.silver import resolve_secondary, resolve_tertiary

COMBO = ["source", "entity_type", "league"]


@dataclass(frozen=True)
class CheckResult:
    """A named check; ``severity`` is 'error' or 'warn'."""

    name: str
    violations: DataFrame
    severity: str = "error"


def summarize(checks: Sequence[CheckResult]) -> DataFrame:
    """One row per check with its number of violations, in one job."""
    counted = [
        c.violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "violations"
        )
        for c in checks
    ]
    return reduce(DataFrame.unionByName, counted)


def unique_violations(df: DataFrame, cols: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """DQ1: keys that occur more than once; ``ignore_nulls`` skips keys with a NULL part."""
    if ignore_nulls:
        df = df.dropna(subset=list(cols))
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ2: every listed column that holds NULLs, all counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counted.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols])).alias("r")
    )
    return long.select("r.*").filter("nulls > 0")


def not_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """DQ3: values outside the list with their count; NULL passes."""
    outside = df.filter(~F.col(col).isin(*values))
    return outside.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def orphans(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """DQ4: rows whose non-NULL key has no parent."""
    return without(df.filter(F.col(col).isNotNull()), parent, {col: parent_col})


def freshness(
    df: DataFrame, group: str, loaded_at: str, now: Column,
    warn_days: int = FRESHNESS_WARN_DAYS, error_days: int = FRESHNESS_ERROR_DAYS,
) -> DataFrame:
    """DQ5: newest load per source and its status against the age limits."""
    newest = df.groupBy(group).agg(F.max(loaded_at).alias("last_loaded"))
    age = lambda days: F.col("last_loaded") < now - F.make_dt_interval(days=F.lit(days))
    status = F.when(age(error_days), "error").when(age(warn_days), "warn").otherwise("pass")
    return newest.withColumn("status", status)


def unmapped_teams(tertiary_standings: DataFrame, secondary_standings: DataFrame) -> DataFrame:
    """DQ6."""
    parts = [
        df.filter("team_id is null").select(F.lit(label).alias("source"), "raw_team_name")
        for label, df in ((TERTIARY, tertiary_standings), (SECONDARY, secondary_standings))
    ]
    return parts[0].unionByName(parts[1])


def unmapped_players(
    secondary: DataFrame, tertiary: DataFrame, players: DataFrame, player_name_map: DataFrame
) -> DataFrame:
    """DQ7: names no lookup resolves."""
    parts = [
        (SECONDARY, resolve_secondary(secondary, players, player_name_map)),
        (TERTIARY, resolve_tertiary(tertiary, players, player_name_map)),
    ]
    missing = [
        df.filter("player_id is null").select(F.lit(label).alias("source"), "raw_player_name") for label, df in parts
    ]
    return missing[0].unionByName(missing[1]).distinct()


def name_collisions(primary: DataFrame, secondary: DataFrame, player_name_map: DataFrame) -> DataFrame:
    """DQ8: secondary names that fit several primary players and are not in the curated map."""
    per_name = (
        primary.select(normalize_name("player_name").alias("norm_name"), "player_id")
        .groupBy("norm_name")
        .agg(F.countDistinct("player_id").alias("fdo_player_count"))
        .filter("fdo_player_count > 1")
    )
    names = secondary.select("raw_player_name").distinct()
    hit = names.withColumn("norm_name", normalize_name("raw_player_name")).join(per_name, "norm_name")
    curated = player_name_map.filter(F.col("source") == SECONDARY)
    return without(hit, curated, ["raw_player_name"]).select("raw_player_name", "fdo_player_count")


def disagreements(player_team_season: DataFrame) -> DataFrame:
    """DQ9."""
    return player_team_season.filter("source_disagreement").select("player_id", "season")


def inconsistent_loans(performance: DataFrame, profile: DataFrame) -> DataFrame:
    """DQ10: loan flags that contradict the team columns, in either mart."""
    bad = F.col("is_on_loan") & (F.col("parent_team_id").isNull() | (F.col("team_id") == F.col("parent_team_id")))
    cols = ["player_id", "season", "team_id", "parent_team_id", "is_on_loan"]
    a = performance.filter(bad).select(*cols)
    b = profile.withColumn("season", F.lit(None).cast("string")).filter(bad).select(*cols)
    return a.unionByName(b)


def unresolved_aliases(aliases: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """DQ11: one null-aware branch per entity type."""
    team = not_in(aliases.filter("entity_type = 'team'"), "entity_id", teams, "team_id")
    player = not_in(aliases.filter("entity_type = 'player'"), "entity_id", players, "player_id")
    return team.unionByName(player).select("entity_type", "alias", "entity_id")


def expected_combos(spark) -> DataFrame:
    """The declared (source, entity_type, league) combinations."""
    return spark.createDataFrame(EXPECTED_COMBOS, "source string, entity_type string, league string")


def census(bronze: DataFrame) -> DataFrame:
    """DQ14 / A10."""
    return bronze.groupBy(*COMBO, "season").agg(F.count(F.lit(1)).alias("count"))


def find_gaps(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """DQ12: expected combinations missing a season that any source has for the league."""
    seasons = counts.filter("league is not null and season is not null").select("league", "season").distinct()
    wanted = expected.join(seasons, "league").select(*COMBO, "season")
    return without(wanted, counts, [*COMBO, "season"])


def find_unexpected(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """DQ13: combinations present but not declared; a NULL league is never declared."""
    return without(counts, expected, COMBO).select(*COMBO, "season")
