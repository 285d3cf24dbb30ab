"""Corpus and index statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.joins import attach
from termloom.plans.numbering import GROUP_LIMIT, first_per_group


def row_count(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count(F.lit(1)).cast("int").alias("n"))


def corpus_stats(docs: DataFrame, postings: DataFrame) -> DataFrame:
    """``doc_count`` (documents without tokens count too) and ``term_count``, one row."""
    doc_count = docs.agg(F.count(F.lit(1)).alias("doc_count"))
    term_count = postings.select("term").distinct().agg(F.count(F.lit(1)))
    return doc_count.select("doc_count", term_count.scalar().alias("term_count"))


def term_sample(postings: DataFrame, terms: int = 10, per_term: int = 5) -> DataFrame:
    """The first ``per_term`` postings of each of the first ``terms`` terms (by UTF-8 bytes)."""
    first = postings.select("term").distinct().orderBy("term").limit(terms)
    sampled = attach(postings, first, "term", "left_semi", fits=terms <= GROUP_LIMIT)
    limited = sampled.withColumn("_per_term", F.lit(per_term))
    return first_per_group(limited, "term", "_per_term", per_term).drop("_per_term")
