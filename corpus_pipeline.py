"""From raw documents to packed sequences: five stages, each one of the llm operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import classifier, packing, rules, simhash, substring
from marketloom.llm.queries import vocabulary
from marketloom.session import stored


def classify(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go."""
    return classifier.accepted(docs)


def judge(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rule or a risk-controlled cutoff of their language go."""
    return rules.accepted(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def strip(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages that an earlier document holds go from the texts; every document stays."""
    clean = substring.without_repeats(docs)
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(packing.pieces(docs, vocabulary(), keep_ids=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("quality_rules", judge),
    ("simhash_near_dedup", dedup),
    ("substring_dedup", strip),
    ("best_fit_packing", pack),
]

#: Hashed scorers, bit distances and token ids have no SQL form; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
