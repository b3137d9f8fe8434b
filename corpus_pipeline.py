"""From raw documents to token sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.llm import mixing, neardup, pieces, quality, sanitise
from searchtide.llm.shared import ship, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the model for quality keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return neardup.keep_one(docs)


def pii_sanitisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and the terms that reveal it taken out of their texts."""
    clean = sanitise.sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, with a mark that they decode to the text."""
    return pieces.encode(docs, pieces.load()).select("doc_id", "lang", "source", "n_tokens", "tokens", "exact")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii_sanitisation", pii_sanitisation),
    ("mixing_sources", mixing_sources),
    ("sentencepiece_tokens", sentencepiece_tokens),
]

#: no SQL: the first stage trains a model, the second finds connected components
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; each result is written to the shared folder and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        rows = stage(ship(spark), rows, sf_dir)
        if number < len(STAGES) - 1:
            rows = staged(rows, name)
    return rows
