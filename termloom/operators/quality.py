"""Checks of an index and of the tables around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.order import proven_unique


def _violations(**rules) -> list:
    return [
        F.coalesce(F.sum(F.when(broken, 1).otherwise(0)), F.lit(0)).cast("long").alias(name)
        for name, broken in rules.items()
    ]


def _as_rows(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "rule", "violations")


def index_checks(
    postings: DataFrame,
    docs: DataFrame | None = None,
    lowest_doc_id: int = 1,
    expected_terms: tuple[str, ...] = (),
    expected_doc_count: int | None = None,
) -> DataFrame:
    """``rule, violations`` of a flat index; all rules but two come from one pass.

    ``duplicate_posting`` has to bring equal postings together unless the order of a stored index
    shows that there are none, ``doc_count`` counts ``docs``.
    """
    one_pass = postings.agg(
        *_violations(
            term=F.col("term").isNull() | (F.col("term") == ""),
            doc_id=F.col("doc_id").isNull() | (F.col("doc_id") < lowest_doc_id),
            tf=F.col("tf").isNull() | (F.col("tf") < 1),
        ),
        *[
            F.when(F.coalesce(F.bool_or(F.col("term") == term), F.lit(False)), 0)
            .otherwise(1)
            .cast("long")
            .alias(f"expected_term:{term}")
            for term in expected_terms
        ],
    )
    if proven_unique(postings, "term", "doc_id"):
        none = F.lit(0).cast("long").alias("duplicate_posting")
        duplicates = postings.sparkSession.range(1).select(none)
    else:
        duplicates = (
            postings.groupBy("term", "doc_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(*_violations(duplicate_posting=F.col("n") > 1))
        )
    result = _as_rows(one_pass).unionByName(_as_rows(duplicates))
    if docs is not None and expected_doc_count is not None:
        off = F.when(F.count(F.lit(1)) != expected_doc_count, 1).otherwise(0).cast("long")
        result = result.unionByName(_as_rows(docs.agg(off.alias("doc_count"))))
    return result


def block_checks(blocks: DataFrame) -> DataFrame:
    """``rule, violations`` of the export form: no empty block, postings ascending."""
    ids = F.transform("postings", lambda posting: posting["doc_id"])
    return _as_rows(
        blocks.agg(
            *_violations(
                empty_block=F.size("postings") < 1, ascending=ids != F.sort_array(ids)
            )
        )
    )


def fingerprint(postings: DataFrame) -> DataFrame:
    """One row that is equal for equal indexes, however they are partitioned or ordered.

    ``hash_sum`` adds the first 60 bits of SHA-256 over ``term|doc_id|tf``.
    """
    text = F.concat_ws("|", "term", F.col("doc_id").cast("string"), F.col("tf").cast("string"))
    first = F.substring(F.sha2(text.cast("binary"), 256), 1, 15)
    # 60 bits fit a long. Their 20-bit parts are added as longs, decimals only at the end.
    hashed = postings.select(F.conv(first, 16, 10).cast("long").alias("h"))
    parts = [F.shiftright("h", shift).bitwiseAND(F.lit((1 << 20) - 1)) for shift in (0, 20, 40)]
    sums = hashed.agg(
        F.count(F.lit(1)).alias("postings"),
        *[F.coalesce(F.sum(part), F.lit(0)).alias(f"part{i}") for i, part in enumerate(parts)],
    )
    whole = [F.col(f"part{i}").cast("decimal(25,0)") * F.lit(1 << 20 * i) for i in range(3)]
    return sums.select("postings", sum(whole[1:], whole[0]).cast("string").alias("hash_sum"))


def freshness(stored: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``stored_postings, rebuilt_postings, fresh``: does a stored index match its documents?"""
    both = (
        fingerprint(stored)
        .withColumn("side", F.lit("stored"))
        .unionByName(fingerprint(rebuilt).withColumn("side", F.lit("rebuilt")))
    )
    # Two rows.
    return both.agg(
        F.max(F.when(F.col("side") == "stored", F.col("postings"))).alias("stored_postings"),
        F.max(F.when(F.col("side") == "rebuilt", F.col("postings"))).alias("rebuilt_postings"),
        (
            (F.min("postings") == F.max("postings"))
            & (F.min("hash_sum") == F.max("hash_sum"))
        ).alias("fresh"),
    )


def missing_fields(documents: DataFrame, *columns: str) -> DataFrame:
    """``rule, violations``: nulls in each required column."""
    return _as_rows(documents.agg(*_violations(**{c: F.col(c).isNull() for c in columns})))


def id_differences(actual: DataFrame, expected: DataFrame, id_column: str = "id") -> DataFrame:
    """``id, side``: ids present on one side only, counting repeats; empty when they agree."""
    left, right = actual.select(id_column), expected.select(id_column)
    return (
        left.exceptAll(right)
        .withColumn("side", F.lit("unexpected"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("missing")))
    )
