"""Keeping an index up to date from a growing corpus folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from termloom.functions.text import DEFAULT_OPTIONS, TokenOptions
from termloom.sources.corpus import corpus
from termloom.sources.index_store import write_build


def follow_corpus(
    spark: SparkSession,
    source: str,
    index_path: str,
    checkpoint: str,
    schema,
    options: TokenOptions = DEFAULT_OPTIONS,
    id_column: str = "doc_id",
    text_column: str = "text",
    name: str | None = None,
    **reader_options: str,
) -> StreamingQuery:
    """Index the files that appeared in ``source`` since the last run, then stop.

    The checkpoint is the resume point. Postings need no state, a document being complete in its
    row; each micro-batch becomes one build of the stream's own source, overwritten if the batch
    is repeated, so every file is indexed exactly once and no other build is touched. The source
    is called ``name``, by default after the checkpoint.
    """
    name = name or f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    stream = spark.readStream.schema(schema).options(**reader_options).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = corpus(batch, id_column, text_column)
        write_build(docs, index_path, batch_id, options, name)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
