"""A corpus pipeline: reject poor documents, keep one of each near-duplicate group, drop repeated passages, pack.

``run`` applies the stages to ``documents``; every stage but the last returns the columns of ``documents``. What a stage
returns is written as Parquet to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slipstream.llm import packing, quality_classifier, quality_rules, simhash_dedup, substring_dedup, subword
from slipstream.llm.staging import staged


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents drawn by importance resampling stay."""
    model = quality_classifier.fit(docs, _labels(spark, sf_dir))
    return quality_classifier.kept_documents(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that pass the base rules and the likelihood ratio stay."""
    model = quality_rules.fit(docs, _labels(spark, sf_dir))
    return quality_rules.kept_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near duplicates, the document with the smallest id stays."""
    return simhash_dedup.one_of_each(docs, shingle=3, distance=3)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: words of passages that an earlier document has go; documents stay."""
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: pieces of at most 1024 tokens and their places in sequences."""
    return packing.packed(docs, subword.public_path(subword.VOCABULARY))


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("best_fit_packing", pack),
]

#: Fitted models, components and packing are not expressible in SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
