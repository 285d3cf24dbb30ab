"""The stored index: postings clustered by term, in builds.

``<path>/version=<n>`` (see ``plans.versions``) holds ``postings``, ``ids`` and ``stats``, each
partitioned by ``source`` and ``build``. A source is a writer with build numbers of its own: ``batch`` for
rebuilds and extensions, one per stream otherwise. A document is in one build: a build leaves
out the documents that others hold. One writer at a time.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termloom import schemas
from termloom.functions.text import DEFAULT_OPTIONS, TokenOptions
from termloom.operators.postings import build_postings
from termloom.plans import versions
from termloom.plans.joins import fits_broadcast
from termloom.plans.staging import small_splits, staged

# Postings per file at most.
ROWS_PER_FILE = 20_000_000
# Postings per range partition when an index is written, which one task sorts: about the first
# number at most, and no fewer than the second just to keep every core busy.
ROWS_PER_TASK = 2_000_000
LEAST_ROWS_PER_TASK = 250_000
BATCH = "batch"


def _write(
    docs: DataFrame,
    folder: str,
    source: str,
    build: int,
    options: TokenOptions,
    one_row_per_doc: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write one build into a version's folder; its row of statistics comes last.

    Tokenising is a map over the corpus, written out once and counted on the way. It is written
    sorted by task: half the size on disk and in the shuffle, and the final sort merges runs.
    Clustering then samples and shuffles that table, not the texts. Ranges are cut on
    ``(term, doc_id)``, so a frequent term gets as many files as it needs and every file still
    covers a narrow range of terms, which the scan's min/max and bloom filters use. What a task
    sorts does not grow with the corpus, and small files are cut from a task's sorted rows.
    """
    spark = docs.sparkSession
    part = f"source={source}/build={build}"
    metrics = Observation()
    with (
        small_splits(spark),
        staged(
            build_postings(docs, options, one_row_per_doc).sortWithinPartitions("term", "doc_id"),
            "postings",
            metrics,
            F.count(F.lit(1)).alias("posting_count"),
        ) as postings,
    ):
        posting_count = metrics.get["posting_count"]
        cores = spark.sparkContext.defaultParallelism
        ranges = max(
            math.ceil(posting_count / ROWS_PER_TASK),
            min(cores, math.ceil(posting_count / LEAST_ROWS_PER_TASK)),
            1,
        )
        clustered = postings.repartitionByRange(ranges, "term", "doc_id").sortWithinPartitions(
            "term", "doc_id"
        )
        writer = clustered.write.option("parquet.bloom.filter.enabled#term", "true")
        writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.mode("overwrite").parquet(f"{folder}/postings/{part}")
    counted = Observation()
    docs.select("doc_id").observe(
        counted, F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")
    ).write.mode("overwrite").parquet(f"{folder}/ids/{part}")
    stats = spark.range(1).select(
        F.lit(json.dumps(asdict(options))).alias("options"),
        F.lit(counted.get["n"]).cast("long").alias("doc_count"),
        F.lit(posting_count).cast("long").alias("posting_count"),
        F.lit(counted.get["last"]).cast("long").alias("max_doc_id"),
    )
    stats.coalesce(1).write.mode("overwrite").parquet(f"{folder}/stats/{part}")


def write_build(
    docs: DataFrame,
    path: str,
    build: int,
    options: TokenOptions = DEFAULT_OPTIONS,
    source: str = BATCH,
    **settings,
) -> None:
    """Add (or repeat) a build of the index at ``path``, with the documents no other build holds."""
    spark = docs.sparkSession
    folder = versions.current(spark, path)
    if folder is None:
        with versions.replacing(spark, path) as folder:
            _write(docs, folder, source, build, options, **settings)
        return
    held = _read(spark, path, "ids", schemas.INDEX_IDS).filter(
        (F.col("source") != source) | (F.col("build") != build)
    )
    # Only the ids of the documents at hand matter.
    wanted = docs.select("doc_id")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    held = held.join(wanted, "doc_id", "left_semi").select("doc_id")
    held = F.broadcast(held) if fits_broadcast(held) else held
    _write(docs.join(held, "doc_id", "left_anti"), folder, source, build, options, **settings)


def rebuild_index(
    docs: DataFrame, path: str, options: TokenOptions = DEFAULT_OPTIONS, **settings
) -> None:
    """Replace the index at ``path``; until the new one is complete the old one is read."""
    with versions.replacing(docs.sparkSession, path) as folder:
        _write(docs, folder, BATCH, 0, options, **settings)


def reset(spark: SparkSession, path: str) -> None:
    """Empty the index; it can be extended again."""
    rebuild_index(spark.createDataFrame([], schemas.CORPUS), path)


def _read(spark: SparkSession, path: str, part: str, schema) -> DataFrame:
    folder = versions.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no inverted index at {path}; build it first")
    return spark.read.schema(schema).parquet(f"{folder}/{part}")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """The stored postings; an error when there is no index."""
    return _read(spark, path, "postings", schemas.POSTINGS).select(*schemas.POSTINGS.names)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """``doc_count, posting_count, max_doc_id`` over all builds, one row."""
    builds = _read(spark, path, "stats", schemas.INDEX_STATS)
    return builds.agg(
        F.coalesce(F.sum("doc_count"), F.lit(0)).alias("doc_count"),
        F.coalesce(F.sum("posting_count"), F.lit(0)).alias("posting_count"),
        F.max("max_doc_id").alias("max_doc_id"),
    )


def read_options(spark: SparkSession, path: str) -> TokenOptions:
    """How the index cuts texts, for cutting queries alike; its builds must agree."""
    found = _read(spark, path, "stats", schemas.INDEX_STATS).select("options").distinct().take(2)
    if len(found) > 1:
        raise ValueError(f"the builds at {path} cut texts in different ways")
    return TokenOptions(**json.loads(found[0]["options"])) if found else DEFAULT_OPTIONS


def extend_index(
    docs: DataFrame, path: str, options: TokenOptions | None = None, **settings
) -> None:
    """Index the documents after the last id of rebuilds and extensions, as a build of their own.

    Texts are cut as the index does unless ``options`` are given.
    """
    spark = docs.sparkSession
    own = _read(spark, path, "stats", schemas.INDEX_STATS).filter(F.col("source") == BATCH)
    last, build = own.agg(F.max("max_doc_id"), F.max("build")).first()
    newer = docs if last is None else docs.filter(F.col("doc_id") > last)
    options = options or read_options(spark, path)
    write_build(newer, path, 0 if build is None else build + 1, options, **settings)
