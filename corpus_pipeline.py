"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before kept, as a table written to the shared folder,
so a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import jaccard, language, mixing, packing, repeats
from cardwarden.llm.queries import tokenizer_path
from cardwarden.session import ship_package, stored


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others carry the language that was identified."""
    ship_package(spark)
    return language.spoken(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return jaccard.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they occur first."""
    ship_package(spark)
    return _with_length(repeats.remove(docs), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, from never to three times."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of a power of two tokens with their ids, a sequence each."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path(), ["doc_id", "source", "lang"])


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Trained models, hashes and a tokenizer decide; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
