"""Reading a corpus to index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import schemas


# Splits of a table that may be dealt anew: a few GB at the usual split size.
SMALL_SPLITS = 32


def spread(scan: DataFrame) -> DataFrame:
    """Rebalance a plain scan of few splits that leaves cores of the session idle.

    Only a table of at most ``SMALL_SPLITS`` splits is ever shuffled; a larger one is returned as
    it is, whatever the number of cores.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(cores) if splits < min(cores, SMALL_SPLITS) else scan


def corpus(
    table: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    extra: tuple[str, ...] = (),
    start_after: int | None = None,
) -> DataFrame:
    """``doc_id, text[, extra]`` of any table; a null text is the empty string.

    ``start_after`` keeps only later ids. It and the column choice reach the parquet scan.
    """
    if start_after is not None:
        table = table.filter(F.col(id_column) > start_after)
    return table.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        *extra,
    )


def read_corpus(spark: SparkSession, path: str, **options) -> DataFrame:
    """``corpus`` of a parquet table, spread over the session's cores."""
    return spread(corpus(spark.read.parquet(path), **options))


def literal_corpus(spark: SparkSession, rows: Iterable[tuple[int, object]]) -> DataFrame:
    """A small corpus given in the program; texts that are not strings are read as empty."""
    checked = {}
    for doc_id, text in rows:
        if isinstance(doc_id, bool) or not isinstance(doc_id, int) or doc_id < 0:
            raise TypeError(f"invalid document id: {doc_id!r}")
        if doc_id in checked:
            raise ValueError(f"duplicate document id: {doc_id}")
        checked[doc_id] = text if isinstance(text, str) else ""
    return spark.createDataFrame(list(checked.items()), schemas.CORPUS)
