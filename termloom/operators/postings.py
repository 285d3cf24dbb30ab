"""The inverted index as a flat table, and its blocked export form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.text import DEFAULT_OPTIONS, TokenOptions, term_counts, tokenize

# Documents per posting block. A block row holds at most this many postings, so the postings
# of a term found in every document are spread over many rows and tasks.
BLOCK_DOCS = 8192
_LARGEST = (1 << 63) - 1


def token_table(docs: DataFrame, options: TokenOptions = DEFAULT_OPTIONS) -> DataFrame:
    """One row per token occurrence: ``doc_id, position, token``."""
    return docs.select(
        "doc_id", F.posexplode(tokenize(F.col("text"), options)).alias("position", "token")
    )


def build_postings(
    docs: DataFrame, options: TokenOptions = DEFAULT_OPTIONS, one_row_per_doc: bool = True
) -> DataFrame:
    """``term, doc_id, tf`` of a corpus ``doc_id, text``.

    A document is one row, so its counts are complete inside the row and the job is a map over
    the scan, without a shuffle. A corpus that spreads a document over several rows needs
    ``one_row_per_doc=False``, which sums the rows' counts.
    """
    counted = docs.select(
        "doc_id", F.inline(term_counts(tokenize(F.col("text"), options))).alias("term", "tf")
    )
    if not one_row_per_doc:
        counted = counted.groupBy("term", "doc_id").agg(F.sum("tf").alias("tf"))
    return counted.select("term", "doc_id", F.col("tf").cast("int").alias("tf"))


def to_blocks(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``term, block, postings`` with the postings of each block ascending by document.

    Concatenating a term's blocks in order gives its whole list.
    """
    return listed(with_blocks(postings, block_docs))


def with_blocks(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    return postings.withColumn("block", F.floor(F.col("doc_id") / block_docs).cast("long"))


def listed(blocked: DataFrame) -> DataFrame:
    """One row per term and ``block``; rows partitioned by these are not moved."""
    return (
        blocked.groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))
        .select("term", "block", "postings")
    )


def from_blocks(blocks: DataFrame) -> DataFrame:
    """Flat postings of a blocked index, keeping each posting's place in ``block, position``."""
    return blocks.select(
        "term", "block", F.posexplode("postings").alias("position", "posting")
    ).select("term", "block", "position", "posting.doc_id", "posting.tf")


def sanitize(postings: DataFrame, order: tuple[str, ...] = ("block", "position")) -> DataFrame:
    """Repair postings restored from outside.

    Ids that are null, negative or not whole are dropped, a frequency that is not a finite
    positive number becomes 0, and of several postings of a document the last one counts.
    ``tf`` is a long; beyond its range stands its largest value.
    """
    return last_of_each(repaired(postings, order))


def _whole(postings: DataFrame) -> Column:
    """Whether ``doc_id`` is a whole number of at least 0."""
    if isinstance(postings.schema["doc_id"].dataType, T.IntegralType):
        return F.col("doc_id").isNotNull() & (F.col("doc_id") >= 0)
    exact = F.expr("try_cast(doc_id AS DECIMAL(38, 18))")
    return exact.isNotNull() & (exact >= 0) & (exact == F.floor(exact))


def _place(postings: DataFrame, order: tuple[str, ...]) -> Column:
    """One value that is ordered like the columns, nulls first.

    Whole numbers make one number, which an aggregation replaces in its hash table; a struct
    makes it sort all rows.
    """
    bits = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32, T.LongType(): 64}
    widths = [bits.get(postings.schema[column].dataType) for column in order]
    if None in widths or sum(widths) > 100:
        return F.struct(*order)
    if len(order) == 1 and widths[0] < 64:
        return F.coalesce(F.col(order[0]).cast("long"), F.lit(-_LARGEST))
    place = None
    for column, width in zip(order, widths):
        lowest = F.lit(str(-(1 << width - 1) - 1)).cast("decimal(38,0)")
        digit = F.coalesce(F.col(column).cast("decimal(38,0)"), lowest)
        scale = F.lit(str(1 << width + 1)).cast("decimal(38,0)")
        place = digit if place is None else (place * scale + digit).cast("decimal(38,0)")
    return place


def repaired(postings: DataFrame, order: tuple[str, ...] = ("block", "position")) -> DataFrame:
    """``sanitize`` but for repeated postings; ``_place`` says which is the last."""
    tf = F.col("tf").cast("double")
    usable = tf.isNotNull() & ~F.isnan(tf) & (tf > 0) & (tf < float("inf"))
    return postings.filter(F.col("term").isNotNull() & _whole(postings)).select(
        "term",
        F.expr("try_cast(doc_id AS BIGINT)").alias("doc_id"),
        F.when(usable & (tf >= float(_LARGEST)), F.lit(_LARGEST))
        .when(usable, tf.cast("long"))
        .otherwise(F.lit(0).cast("long"))
        .alias("tf"),
        _place(postings, order).alias("_place"),
    )


def last_of_each(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term", "doc_id").agg(F.max_by("tf", "_place").alias("tf"))
