"""Preparing a training corpus: quality rules, near-duplicates, personal data, mixing to target weights, encoding.

Each stage takes the documents that its predecessor kept; ``run`` writes a stage's rows as Parquet into the shared checkpoint
folder and reads them again for the next, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, minhash, mixing, pii, quality_rules
from touchline.llm.common import shared_folder
from touchline.llm.queries import SURROGATE_KEY, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy accepts."""
    return quality_rules.accepted(docs, "standard-1")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, for each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash.deduplicated(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the new text."""
    replaced = pii.pseudonymised(docs, SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else replaced


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, one row for each time that a document is taken."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) and their number; ``exact`` tells whether decoding gives the text back."""
    path = tokenizer_path()
    ids = bpe.encode(docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("want")), path)
    back = bpe.decode(ids.withColumn("packed", F.col("ids")), path)
    return back.select(
        "doc_id", "source", F.col("packed").alias("ids"), (F.length("packed") / 4).cast("long").alias("n_tokens"),
        (F.sha2(F.col("text").cast("binary"), 256) == F.col("want")).alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", apply_quality_rules),
    ("near duplicates", drop_near_duplicates),
    ("personal data", replace_personal_data),
    ("source mix", mix_sources),
    ("byte pairs", encode),
]

#: SQL has no statement for near-duplicates by signature, keyed surrogates and byte-pair merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = shared_folder(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        if k:
            docs.write.parquet(f"{name}/{k}")
            docs = spark.read.parquet(f"{name}/{k}")
        docs = stage(spark, docs, sf_dir)
    return docs
