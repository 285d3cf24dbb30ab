"""Exact deduplication as a stream with disk-backed keyed state.

Every row arrives as (digest, id, place): the SHA-256 of its whole text, its ``doc_id`` and where
its text lies (``common.ROW``). A streaming aggregation keeps, per digest and without expiry, the
row that stays (largest id), the place of its text and the number of rows; the state lives in
RocksDB and is checkpointed to the shared folder, so a later call with the same ``store``
goes on from it. State is partitioned by digest and copies are combined before the shuffle, so a
group with a third of all rows is one state row and no hot task.

A digest that was seen before is only a hit: the full bytes are compared with the text at
the kept place. A group's comparison is dealt over as many slots as its size asks for, the kept
text being sent to each. Texts that differ in spite of equal digests form groups of their own.

Only DataFrame and streaming operations; no Python runs on the executors.

Nulls and repeats: a null text is empty; empty texts are equal to each other. A null id ranks below
all ids, so such a row stays only if no copy has an id. Rows repeated with the same id and text are
copies like others: the one at the largest place stays. Other columns play no part. An
empty table gives an empty result.
"""

from __future__ import annotations

import contextlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, text_column, without
from termloom.plans.joins import fits_broadcast
from termloom.plans.staging import new_path, stage

# Rows of a group compared with the kept text in one slot.
SLOT_ROWS = 500
# Digests taken into one micro-batch.
BATCH_BYTES = 64 << 30

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # One bounded cache for all the state an executor holds; the rest stays on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: no disk is set aside ahead of its use.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.metricsEnabled": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _slots(size: str):
    return F.ceil(F.col(size) / SLOT_ROWS).cast("int")


def arrivals(placed: DataFrame) -> DataFrame:
    """The narrow rows that go through the state."""
    text = text_column()
    return placed.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *ROW,
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )


def follow(spark: SparkSession, store: str, schema) -> DataFrame:
    """Bring the state up to date with the feed; the state as ``digest``, ``keep``, ``n``."""
    feed = (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", BATCH_BYTES)
        .parquet(f"{store}/feed")
    )
    keeper = F.max(F.struct("doc_id", *ROW)).alias("keep")
    groups = feed.groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("n"))
    with _settings(spark, STATE_SETTINGS):
        run = (
            groups.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", f"{store}/state")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        state = spark.read.format("statestore").load(f"{store}/state")
    keep, n = (F.col(f"value.`{name}`") for name in state.schema["value"].dataType.names)
    return state.select(F.col("key.digest").alias("digest"), keep.alias("keep"), n.alias("n"))


def differing(placed: DataFrame, members: DataFrame) -> DataFrame:
    """The members (``ROW``, ``digest``, ``keep``, ``n``) whose bytes are not the kept text's."""
    sent = F.broadcast(members) if fits_broadcast(members) else members
    texts = placed.select(*ROW, text_column().alias("text")).join(sent, list(ROW))
    kept = texts.filter(is_kept()).select(
        "digest",
        F.col("text").alias("kept_text"),
        F.explode(F.sequence(F.lit(0), _slots("n") - 1)).alias("slot"),
    )
    others = texts.filter(~is_kept()).withColumn(
        "slot", F.pmod(F.xxhash64(*ROW), _slots("n")).cast("int")
    )
    pairs = others.join(kept, ["digest", "slot"])
    return pairs.filter(F.col("text") != F.col("kept_text")).select(
        *ROW, "doc_id", "digest", "text"
    )


def decide(docs: DataFrame, store: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, place, digest, group size and the row that stays.

    With the ``store`` of an earlier call on a table that has since got more files, only the new
    files' rows go through the stream.
    """
    return _decide(located(docs), store)


def _decide(placed: DataFrame, store: str | None = None) -> DataFrame:
    spark = placed.sparkSession
    new = arrivals(placed)
    if store is None:
        store = new_path(spark, "exact-dedup")
    else:
        known = spark.read.schema(new.schema).option("ignoreMissingFiles", True)
        with contextlib.suppress(AnalysisException):  # nothing was fed yet
            new = new.join(known.parquet(f"{store}/feed"), list(ROW), "left_anti")
    new.write.mode("append").parquet(f"{store}/feed")
    feed = spark.read.schema(new.schema).parquet(f"{store}/feed")
    hits = stage(follow(spark, store, new.schema).filter("n > 1"), "exact-dedup-hits")
    if fits_broadcast(hits):
        hits = F.broadcast(hits)
    members = feed.join(hits, "digest")
    unequal = stage(differing(placed, members), "exact-dedup-unequal")
    decided = feed.join(hits, "digest", "left").select(
        "doc_id",
        *ROW,
        "digest",
        F.coalesce("keep", F.struct("doc_id", *ROW)).alias("keep"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
    )
    if unequal.isEmpty():
        return decided
    apart = unequal.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", *ROW)).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    left = unequal.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    rest = (
        decided.join(unequal.select(*ROW), list(ROW), "left_anti")
        .join(left, "digest", "left")
        .withColumn("group_size", F.col("group_size") - F.coalesce("gone", F.lit(0)))
    )
    moved = unequal.join(apart, ["digest", "text"])
    return rest.select(*decided.columns).unionByName(moved.select(*decided.columns))


def is_kept():
    return (F.col("keep._file") == F.col("_file")) & (F.col("keep._at") == F.col("_at"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs``, all columns unchanged, with one row of each group of equal texts."""
    placed = located(docs)
    return without(placed, _decide(placed).filter(~is_kept()))
