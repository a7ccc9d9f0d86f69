"""Reference files with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline import schemas


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One reference CSV; unknown names are refused."""
    return spark.read.schema(schemas.SEEDS[name]).option("header", True).csv(f"{folder}/{name}.csv")


def read_seeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All reference files."""
    return {name: read_seed(spark, folder, name) for name in schemas.SEEDS}
