"""Corpus cleaning: toxic documents, copies, near copies and benchmark leaks go; the rest is packed.

Every stage takes the documents its predecessor kept and is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import decontamination, exact_dedup, near_dedup, packing, queries, toxicity
from termloom.plans.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# The toxicity and near-duplicate stages are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
