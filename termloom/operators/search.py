"""Boolean search and the ranked term query over postings."""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.snippet import snippet
from termloom.functions.text import QUERY_OPTIONS, TokenOptions, tokenize
from termloom.operators.lookup import existing, narrowed
from termloom.plans.numbering import GROUP_LIMIT, first_by_id
from termloom.plans.staging import stage

# Documents per page of a response. Pages are ranges of doc_id, so a page has at most this many
# hits and no row grows with the corpus.
PAGE_DOCS = 8192
# What a number in a request may look like.
DECIMAL = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
LARGEST_LIMIT = (1 << 63) - 1


def check_mode(mode: str | None) -> str:
    """``and`` (also when empty) or ``or``; anything else is an error."""
    lowered = (mode or "").lower()
    if lowered in ("", "and"):
        return "and"
    if lowered == "or":
        return "or"
    raise ValueError("invalid_mode: known modes are and, or")


def check_limit(limit) -> int | None:
    """None when absent, otherwise the whole part of a finite number of at least 0.

    Texts are read as the batch form reads them: a blank one is 0, and ``DECIMAL`` is the form of
    all others. A number beyond ``LARGEST_LIMIT`` asks for all hits, as that does.
    """
    if limit is None or limit == "":
        return None
    if isinstance(limit, str):
        limit = 0 if not limit.strip(" ") else limit if re.match(DECIMAL, limit) else math.nan
    try:
        number = float(limit)
    except (TypeError, ValueError):
        number = math.nan
    if not math.isfinite(number) or number < 0:
        raise ValueError("invalid_limit: the limit has to be a finite number from 0")
    return min(int(number), LARGEST_LIMIT)


def query_terms(
    spark: SparkSession, q: str | None, options: TokenOptions = QUERY_OPTIONS
) -> list[str]:
    """The tokens of one query text, in order and with duplicates.

    The text is a literal, normalised here, and cut by the same expression that cuts documents.
    """
    text = unicodedata.normalize("NFC", q or "")
    cut = tokenize(F.lit(text), replace(options, assume_nfc=True))
    # A literal row, which the optimizer evaluates: no job is run.
    return list(spark.sql("VALUES (1)").select(cut.alias("terms")).first()["terms"])


def matching_docs(postings: DataFrame, terms: list[str], mode: str = "and") -> DataFrame:
    """Distinct ``doc_id`` holding all (``and``) or any (``or``) of ``terms``.

    Postings are unique per term and document. One term therefore needs no shuffle, and a
    document has all k terms when k of its postings match: one shuffle, of matching doc ids
    counted within each task first.
    """
    wanted = list(dict.fromkeys(terms))
    if not wanted:
        return postings.select("doc_id").limit(0)
    matches = postings.filter(F.col("term").isin(*wanted))
    if len(wanted) == 1:
        return matches.select("doc_id")
    if mode == "or":
        return matches.select("doc_id").distinct()
    return (
        matches.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == len(wanted))
        .select("doc_id")
    )


def ordered(hits: DataFrame, limit: int | None) -> DataFrame:
    """Hits ascending by document, the first ``limit`` of them if there is a limit."""
    return hits.orderBy("doc_id") if limit is None else first_by_id(hits, limit)


def search(
    postings: DataFrame,
    q: str,
    mode: str | None = "and",
    limit=None,
    options: TokenOptions = QUERY_OPTIONS,
) -> DataFrame:
    """``doc_id`` of the documents matching ``q``, ascending.

    ``options`` are those of the index (``index_store.read_options``).
    """
    mode, limit = check_mode(mode), check_limit(limit)
    terms = query_terms(postings.sparkSession, q, options)
    return ordered(matching_docs(postings, terms, mode), limit)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents in both hit sets."""
    return left.select("doc_id").intersect(right.select("doc_id"))


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents in either hit set."""
    return left.select("doc_id").union(right.select("doc_id")).distinct()


def hits_with_snippets(hits: DataFrame, docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, snippet``; the snippet is null for a missing document or without a hit.

    Snippets are cut before the join, so that a few dozen characters of a text are shuffled and
    not the text.
    """
    words = F.array(*[F.lit(term) for term in terms]).cast("array<string>")
    cut = narrowed(docs, hits).select("doc_id", snippet(F.col("text"), words).alias("snippet"))
    return hits.join(cut, "doc_id", "left").select("doc_id", "snippet")


def _local(rows: DataFrame) -> tuple[DataFrame, list[int]]:
    """Rows known to be few, held by the driver, with their document ids as literals."""
    table = rows.toArrow()
    return rows.sparkSession.createDataFrame(table), table["doc_id"].to_pylist()


def search_response(
    postings: DataFrame,
    q: str,
    mode: str | None = "and",
    limit=None,
    docs: DataFrame | None = None,
    page_docs: int = PAGE_DOCS,
    options: TokenOptions = QUERY_OPTIONS,
    id_column: str = "doc_id",
) -> DataFrame:
    """``q, mode, terms, count, page, doc_ids[, results]``.

    ``count`` is the number of hits after the limit and stands on every page. The hits are paged
    by doc-id range; a search without hits has one empty page. ``results`` (``doc_id, snippet``)
    is added when ``docs`` is given. The postings are read once: the hits are held by the driver
    if a limit keeps them few, and written otherwise. ``options`` are those of the index.
    """
    mode, limit = check_mode(mode), check_limit(limit)
    terms = query_terms(postings.sparkSession, q, options)
    hits = matching_docs(postings, terms, mode)
    docs = docs.withColumnRenamed(id_column, "doc_id") if docs is not None else None
    page = F.floor(F.col("doc_id") / page_docs).cast("long")
    if limit is not None:
        hits = first_by_id(hits, limit)
    if limit is not None and limit <= GROUP_LIMIT:
        # At most GROUP_LIMIT rows; as literals they let the document scan skip row groups.
        hits, ids = _local(hits)
        docs = docs.filter(F.col("doc_id").isin(ids)) if docs is not None else None
    else:
        hits = stage(hits, "hits")
    total = hits.agg(F.count(F.lit(1)))
    if docs is not None:
        hits = hits_with_snippets(hits, docs, terms)
    entry = F.struct("doc_id", *(["snippet"] if docs is not None else []))
    pages = hits.groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(entry)).alias("hits"))
    pages = pages.withColumn("count", total.scalar())
    empty = postings.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("page"),
        F.array().cast(pages.schema["hits"].dataType).alias("hits"),
        total.scalar().alias("count"),
    )
    columns = [
        F.lit(q).alias("q"),
        F.lit(mode).alias("mode"),
        F.array(*[F.lit(term) for term in terms]).cast("array<string>").alias("terms"),
        F.col("count"),
        F.col("page"),
        F.transform("hits", lambda hit: hit["doc_id"]).alias("doc_ids"),
    ]
    if docs is not None:
        columns.append(F.col("hits").alias("results"))
    return pages.unionByName(empty.filter(F.col("count") == 0)).select(*columns)


def term_topk(
    postings: DataFrame,
    documents: DataFrame,
    term: str,
    k: int = 10,
    verified: bool = False,
    id_column: str = "doc_id",
) -> DataFrame:
    """The ``k`` documents with the highest frequency of ``term``, ties by the lower id.

    The term is lowercased, not tokenised. Postings without a stored document do not count, so
    only the documents' ids meet the postings before the cut; an index known to match its
    documents (``verified``, see ``quality.freshness``) needs not even that. Whole documents are
    then read for the ``k`` that are left.
    """
    if k < 1:
        raise ValueError("k must be a positive integer")
    documents = documents.withColumnRenamed(id_column, "doc_id")
    matches = postings.filter(F.col("term") == term.lower()).select("doc_id", "tf")
    if not verified:
        matches = existing(matches, documents)
    best = [F.desc("tf"), F.asc("doc_id")]
    top = matches.orderBy(*best).limit(k)
    if k > GROUP_LIMIT:
        return documents.join(top, "doc_id").orderBy(*best)
    # At most GROUP_LIMIT rows; their ids as literals let the document scan skip row groups.
    top, ids = _local(top)
    found = documents.filter(F.col("doc_id").isin(ids))
    return found.join(F.broadcast(top), "doc_id").orderBy(*best)
