"""Intermediate tables in the shared folder.

A written table cuts lineage and survives lost executors: a retried task reads the same files
again instead of recomputing, so anything derived from row positions stays put.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

from termloom.session import shared_dir

# Rows of an Arrow batch where Python reads whole texts: a worker and its executor hold two at a time.
BATCH_ROWS = 1000
# Bytes per split where a task sorts or shuffles the postings of its split: texts give some 150
# postings per KB of parquet, stored postings some 300.
SPLIT_BYTES = 16 << 20


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/termloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return the frame that reads it back."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_splits(spark: SparkSession, most: int = SPLIT_BYTES):
    """Scans of a block in splits of at most ``most`` bytes, so that a task holds few postings."""
    key = "spark.sql.files.maxPartitionBytes"
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return settings(spark, {key: str(min(most, size))})


def small_batches(spark: SparkSession, most: int = BATCH_ROWS):
    """Arrow batches of at most ``most`` rows in the jobs of a block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    return settings(spark, {key: str(min(most, rows) if rows > 0 else most)})


@contextmanager
def staged(
    df: DataFrame, label: str, observation: Observation | None = None, *metrics
) -> Iterator[DataFrame]:
    """``stage`` for the length of a block; the files are removed at its end."""
    spark = df.sparkSession
    path = new_path(spark, label)
    try:
        yield stage(df.observe(observation, *metrics) if observation else df, label, path)
    finally:
        remove(spark, path)
