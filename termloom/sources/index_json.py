"""The index as JSON."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termloom import schemas
from termloom.operators.postings import (
    BLOCK_DOCS,
    from_blocks,
    last_of_each,
    listed,
    repaired,
    sanitize,
    with_blocks,
)
from termloom.plans.order import proven_unique
from termloom.plans.staging import small_splits, staged

# Postings per range partition of an export, about.
ROWS_PER_TASK = 2_000_000
# One object holding the whole index, as single-machine tools write it.
WHOLE_INDEX = "docCount bigint, postings map<string, array<struct<docId: string, tf: double>>>"


def write_index_json(
    postings: DataFrame, path: str, doc_count: int, block_docs: int = BLOCK_DOCS
) -> None:
    """One JSON line per term and block, globally sorted, with the statistics beside them.

    The order makes rebuilds of the same index equal line by line. The postings are written once
    and dealt to ranges of term and block, where they are grouped without another shuffle.
    """
    metrics = Observation()
    with (
        small_splits(postings.sparkSession),
        staged(
            with_blocks(postings, block_docs).sortWithinPartitions("term", "block"),
            "postings",
            metrics,
            F.count(F.lit(1)).alias("n"),
        ) as flat,
    ):
        cores = postings.sparkSession.sparkContext.defaultParallelism
        ranges = max(math.ceil(metrics.get["n"] / ROWS_PER_TASK), cores)
        blocks = listed(flat.repartitionByRange(ranges, "term", "block"))
        blocks.sortWithinPartitions("term", "block").write.mode("overwrite").json(f"{path}/postings")
    postings.sparkSession.range(1).select(F.lit(doc_count).alias("docCount")).write.mode(
        "overwrite"
    ).json(f"{path}/stats")


def read_blocks_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POSTING_BLOCKS).json(f"{path}/postings")


def read_index_json(spark: SparkSession, path: str) -> DataFrame:
    """Flat, repaired postings of an export.

    An export lies in order, which shows that no posting is repeated; otherwise the last one counts.
    """
    found = repaired(from_blocks(read_blocks_json(spark, path)))
    if proven_unique(found, "term", "doc_id"):
        return found.drop("_place")
    return last_of_each(found)


def read_doc_count(spark: SparkSession, path: str) -> DataFrame:
    """``doc_count`` of an export, 0 when it is missing."""
    stats = spark.read.schema("docCount bigint").json(f"{path}/stats")
    return stats.agg(F.coalesce(F.max("docCount"), F.lit(0)).alias("doc_count"))


def read_whole_index(spark: SparkSession, path: str) -> DataFrame:
    """Flat, repaired postings of files ``{"docCount": n, "postings": {term: [{docId, tf}]}}``.

    A file is read by one task; such files come from programs that held the index in memory.
    """
    files = spark.read.schema(WHOLE_INDEX).option("multiLine", True).json(path)
    listed = files.select(F.explode("postings").alias("term", "postings"))
    flat = listed.select("term", F.posexplode("postings").alias("position", "posting")).select(
        "term",
        F.lit(0).alias("block"),
        "position",
        F.expr("try_cast(posting.docId AS DECIMAL(38, 6))").alias("doc_id"),
        "posting.tf",
    )
    return sanitize(flat)


def read_whole_doc_count(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.schema(WHOLE_INDEX).option("multiLine", True).json(path)
    return files.agg(F.coalesce(F.sum("docCount"), F.lit(0)).alias("doc_count"))
