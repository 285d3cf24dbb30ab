"""Many queries at once, as joins over the postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import QUERY_OPTIONS, TokenOptions, tokenize
from termloom.operators.search import DECIMAL, LARGEST_LIMIT, PAGE_DOCS
from termloom.plans.joins import BROADCAST_BYTES, ROW_OVERHEAD, attach
from termloom.plans.numbering import GROUP_LIMIT, first_per_group
from termloom.plans.staging import stage


def check_requests(requests: DataFrame) -> DataFrame:
    """Requests ``query_id, q, mode, limit`` as text, with the checked values and a ``reason``.

    ``mode`` becomes ``and`` or ``or`` and ``limit`` a whole number or null (no limit). A bad
    request keeps its row: ``reason`` is ``invalid_mode`` or ``invalid_limit``, else null.
    """
    mode = F.lower(F.coalesce(F.col("mode"), F.lit("")))
    raw = F.coalesce(F.col("limit"), F.lit(""))
    # A blank but not empty text counts as the number 0.
    number = F.when(F.trim(raw) == "", F.lit(0.0)).when(
        raw.rlike(DECIMAL), F.expr("try_cast(trim(`limit`) AS DOUBLE)")
    )
    bad_limit = (raw != "") & (number.isNull() | (number < 0) | (number == float("inf")))
    checked_mode = F.when(mode == "or", "or").when(mode.isin("and", ""), "and")
    whole = F.when(number >= float(LARGEST_LIMIT), F.lit(LARGEST_LIMIT)).otherwise(
        F.floor(number).cast("long")
    )
    return requests.select(
        "query_id",
        "q",
        checked_mode.alias("mode"),
        F.when((raw != "") & ~bad_limit, whole).alias("limit"),
        F.when(checked_mode.isNull(), "invalid_mode")
        .when(bad_limit, "invalid_limit")
        .alias("reason"),
    )


def prepare(queries: DataFrame, options: TokenOptions = QUERY_OPTIONS) -> DataFrame:
    """Queries ``query_id, q, mode, limit`` with their tokens, written once.

    Any mode but ``or`` means ``and``; a limit below 0 means 0. Query ids must be unique.
    """
    tokens = tokenize(F.col("q"), options)
    return stage(
        queries.select(
            "query_id",
            "q",
            F.when(F.col("mode") == "or", "or").otherwise("and").alias("mode"),
            F.when(F.col("limit") < 0, 0).otherwise(F.col("limit")).cast("long").alias("limit"),
            tokens.alias("terms"),
        ),
        "queries",
    )


def _distinct_terms(queries: DataFrame) -> DataFrame:
    terms = F.array_distinct("terms")
    return queries.select(
        "query_id", "limit", F.size(terms).alias("wanted"), F.explode(terms).alias("term")
    )


def _or_hits(postings: DataFrame, queries: DataFrame, first: int | None, size: dict) -> DataFrame:
    """``query_id, limit, doc_id``, distinct. With ``first``, at least the first so many hits.

    The first k hits of a query are among the first k postings of its terms, so a frequent term
    brings k rows to the join and not all its documents.
    """
    words = _distinct_terms(queries).select("query_id", "limit", "term")
    if first is not None:
        vocabulary = words.select("term")
        postings = attach(postings, vocabulary, "term", "left_semi", **size)
        rank = F.row_number().over(Window.partitionBy("term").orderBy("doc_id"))
        postings = postings.withColumn("_rank", rank).filter(F.col("_rank") <= first)
    return (
        attach(postings.drop("_rank"), words, "term", **size)
        .select("query_id", "limit", "doc_id")
        .distinct()
    )


def _and_hits(postings: DataFrame, queries: DataFrame, size: dict) -> DataFrame:
    """``query_id, limit, doc_id``, distinct.

    Only a query's rarest term is joined to the postings. Each of its documents then looks up the
    other terms by term and document, so what is shuffled and grouped follows the rarest term;
    frequent terms' postings are only read and filtered.
    """
    words = _distinct_terms(queries)
    found_in = postings.groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    # A query with a term that no document has is dropped here: it has no hits.
    anchors = stage(
        attach(words, found_in, "term", **size)
        .groupBy("query_id", "limit", "wanted")
        .agg(
            F.count(F.lit(1)).alias("known"),
            F.sort_array(F.collect_list(F.struct("docs", "term"))).alias("by_rarity"),
        )
        .filter(F.col("known") == F.col("wanted"))
        .select(
            "query_id",
            "limit",
            F.get("by_rarity", F.lit(0))["term"].alias("term"),
            F.transform(F.slice("by_rarity", 2, F.size("by_rarity")), lambda e: e["term"]).alias(
                "others"
            ),
        ),
        "anchors",
    )
    alone = F.size("others") == 0
    single = attach(postings, anchors.filter(alone), "term", **size).select(
        "query_id", "limit", "doc_id"
    )
    # One row per candidate and other term, which has a posting or has not.
    wanted = stage(
        attach(postings, anchors.filter(~alone), "term", **size).select(
            "query_id",
            "limit",
            "doc_id",
            F.size("others").alias("wanted"),
            F.explode("others").alias("term"),
        ),
        "candidates",
    )
    checked = wanted.join(postings.select("term", "doc_id"), ["term", "doc_id"])
    verified = (
        checked.groupBy("query_id", "limit", "doc_id", "wanted")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == F.col("wanted"))
    )
    return single.unionByName(verified.select("query_id", "limit", "doc_id"))


def batch_hits(
    postings: DataFrame, prepared: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``query_id, doc_id`` of every prepared query, after its limit.

    The index is read once, for the postings of the batch's vocabulary, and these are written; so
    postings that are not stored are computed once. Then queries go by mode and by size of limit (none, small, large), each kind through the
    joins that suit it.
    """
    words = _distinct_terms(prepared)
    limit = F.col("limit")
    is_or = F.col("mode") == "or"
    kinds = {
        "free": limit.isNull(),
        "small": limit.isNotNull() & (limit <= GROUP_LIMIT),
        "large": limit.isNotNull() & (limit > GROUP_LIMIT),
    }
    asked = F.size("terms") > 0
    modes = {"or": is_or, "and": ~is_or}
    row = F.size("terms") * (ROW_OVERHEAD + 48) + F.octet_length(F.concat_ws("", "terms"))
    seen = prepared.agg(
        F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes"),
        *[F.max(F.when(kind & asked, limit)).alias(name) for name, kind in kinds.items()],
        *[
            F.coalesce(F.bool_or(kind & asked & chosen), F.lit(False)).alias(f"{mode}_{name}")
            for name, kind in kinds.items()
            for mode, chosen in modes.items()
        ],
    ).first()
    # The sides joined below are parts of ``words``, or its rows folded per query.
    size = {"broadcast_bytes": broadcast_bytes, "fits": seen["bytes"] <= broadcast_bytes}
    if not size["fits"]:
        # A shuffle join reads them several times.
        postings = stage(postings.select("term", "doc_id"), "postings")
    relevant = attach(postings, words.select("term"), "term", "left_semi", **size)
    postings = stage(relevant.select("term", "doc_id"), "relevant")

    def cut(hits: DataFrame, name: str) -> DataFrame:
        if name == "free":
            return hits
        return first_per_group(hits, "query_id", "limit", seen[name])

    parts = []
    and_hits = None
    for name, kind in kinds.items():
        if seen[f"or_{name}"]:
            first = seen[name] if name == "small" else None
            hits = _or_hits(postings, prepared.filter(is_or & kind), first, size)
            parts.append(cut(hits, name))
        if seen[f"and_{name}"]:
            if and_hits is None:
                and_hits = _and_hits(postings, prepared.filter(~is_or & asked), size)
            parts.append(cut(and_hits.filter(kind), name))
    if not parts:
        return prepared.sparkSession.createDataFrame([], "query_id long, doc_id long")
    return reduce(DataFrame.unionByName, [part.select("query_id", "doc_id") for part in parts])


def batch_responses(
    postings: DataFrame,
    queries: DataFrame,
    page_docs: int = PAGE_DOCS,
    broadcast_bytes: int = BROADCAST_BYTES,
    options: TokenOptions = QUERY_OPTIONS,
) -> DataFrame:
    """``query_id, q, mode, terms, count, page, doc_ids``: the answers to a batch of queries.

    ``count`` is taken after the limit. Hits are paged by doc-id range; a query without hits has
    one empty page. ``options`` are those of the index.
    """
    prepared = prepare(queries, options)
    hits = stage(batch_hits(postings, prepared, broadcast_bytes), "batch-hits")
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("count"))
    answered = stage(
        prepared.join(counts, "query_id", "left").select(
            "query_id", "q", "mode", "terms", F.coalesce("count", F.lit(0)).alias("count")
        ),
        "answered",
    )
    page = F.floor(F.col("doc_id") / page_docs).cast("long").alias("page")
    pages = hits.groupBy("query_id", page).agg(
        F.sort_array(F.collect_list("doc_id")).alias("doc_ids")
    )
    columns = ["query_id", "q", "mode", "terms", "count", "page", "doc_ids"]
    filled = attach(pages, answered, "query_id", broadcast_bytes=broadcast_bytes)
    empty = answered.filter(F.col("count") == 0).select(
        "*", F.lit(0).cast("long").alias("page"), F.array().cast("array<bigint>").alias("doc_ids")
    )
    return filled.select(*columns).unionByName(empty.select(*columns))
