"""Lookups by document and by term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.joins import attach, fits_broadcast
from termloom.plans.numbering import first_by_id, newest


def document_by_id(documents: DataFrame, doc_id, id_column: str = "id") -> DataFrame:
    """The document with this id; empty unless the id is a whole number of at least 1."""
    try:
        number = float(doc_id)
        wanted = int(doc_id) if isinstance(doc_id, int) else int(number)
    except (TypeError, ValueError, OverflowError):
        return documents.limit(0)
    if number != wanted or wanted < 1:
        return documents.limit(0)
    return documents.filter(F.col(id_column) == wanted)


def narrowed(documents: DataFrame, hits: DataFrame) -> DataFrame:
    """The documents of the hits, if the hits are few enough to broadcast; else all of them.

    For use before a join on ``doc_id``: for few hits the texts of other documents stay put.
    """
    wanted = hits.select("doc_id").distinct()
    if fits_broadcast(wanted):
        return documents.join(F.broadcast(wanted), "doc_id", "left_semi")
    return documents


def with_documents(hits: DataFrame, documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each hit with its document; a hit whose document is missing keeps nulls."""
    documents = documents.withColumnRenamed(id_column, "doc_id")
    return hits.join(narrowed(documents, hits), "doc_id", "left")


def existing(hits: DataFrame, documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The hits whose document is stored; only the documents' ids are read."""
    return hits.join(documents.select(F.col(id_column).alias("doc_id")), "doc_id", "left_semi")


def term_postings(postings: DataFrame, *terms: str) -> DataFrame:
    """Postings of the given terms; an unknown term has none. The filter reaches the scan."""
    return postings.filter(F.col("term").isin(*terms))


def terms_postings(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of every term in ``terms(term)``."""
    return attach(postings, terms, "term", "left_semi")


def by_recency(
    documents: DataFrame, limit: int, created: str = "created_at", id_column: str = "id"
) -> DataFrame:
    """The newest documents first, ties by the higher id."""
    return newest(documents, limit, created, id_column)


def by_id(documents: DataFrame, limit: int, id_column: str = "id") -> DataFrame:
    """The first documents by id."""
    return first_by_id(documents, limit, id_column)
