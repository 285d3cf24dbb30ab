"""The documents table: batch files, validation, inserts, upserts, reset."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import schemas
from termloom.plans import versions
from termloom.plans.joins import BROADCAST_BYTES, fits_broadcast
from termloom.plans.numbering import with_dense_ids

# The characters that trimming removes.
BLANKS = (
    r"\t\n\x{b}\f\r \x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
)


def _field(item: Column, *names: str) -> Column:
    """The first of the named fields that is present and not null, as a variant."""
    found = [F.try_variant_get(item, f"$.{name}", "variant") for name in names]
    return F.coalesce(*[F.when(~F.is_variant_null(value), value) for value in found])


def _text(value: Column) -> Column:
    """A string value; null when the value is of another type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """``file, index, is_object, title, body, created_at, created_at_ok`` of JSON batch files.

    A file is ``{"documents": […]}``, ``{"docs": […]}`` or a bare array; ``content`` stands in
    for ``body`` and ``createdAt`` for ``created_at``. A title or body that is not a string is
    null; ``created_at_ok`` is false where a time is given but cannot be read. Anything else than
    an array of documents is an error that names the file. One file is one task, so large
    deliveries should come as many files.
    """
    files = (
        spark.read.option("multiLine", True)
        .option("singleVariantColumn", "v")
        .json(path)
        .select(F.input_file_name().alias("file"), "v")
    )
    kind = F.schema_of_variant("v")
    items = F.when(kind.startswith("ARRAY"), F.col("v")).otherwise(
        _field(F.col("v"), "documents", "docs")
    )
    is_array = items.isNull() | F.schema_of_variant(items).startswith("ARRAY")
    wrong = F.raise_error(F.concat(F.lit("documents must be an array in "), F.col("file")))
    checked = F.when(is_array, F.try_variant_get(items, "$", "array<variant>")).otherwise(wrong)
    return files.select("file", F.posexplode(checked).alias("index", "item")).select(
        "file",
        "index",
        F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False)).alias(
            "is_object"
        ),
        _text(_field(F.col("item"), "title")).alias("title"),
        _text(_field(F.col("item"), "body", "content")).alias("body"),
        F.try_variant_get(_field(F.col("item"), "created_at", "createdAt"), "$", "string").alias(
            "_created"
        ),
    ).select(
        "file",
        "index",
        "is_object",
        "title",
        "body",
        F.expr("try_cast(_created AS TIMESTAMP)").alias("created_at"),
        F.expr("_created IS NULL OR try_cast(_created AS TIMESTAMP) IS NOT NULL").alias(
            "created_at_ok"
        ),
    )


def _blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(f"[^{BLANKS}]")


def reject_reason(batch: DataFrame) -> Column:
    """Why a row cannot be stored, or null; texts are judged trimmed but stored as they are."""
    # The reasons.
    reason = F.when(_blank(F.col("title")), "title is required").when(
        _blank(F.col("body")), "body is required"
    )
    if "created_at_ok" in batch.columns:
        reason = reason.when(~F.col("created_at_ok"), "created_at is not a time")
    if "is_object" in batch.columns:
        reason = F.when(~F.col("is_object"), "must be an object").otherwise(reason)
    return reason


def valid_rows(batch: DataFrame) -> DataFrame:
    return batch.filter(reject_reason(batch).isNull())


def rejected_rows(batch: DataFrame) -> DataFrame:
    """The rows that cannot be stored, with their ``reason``."""
    return batch.withColumn("reason", reject_reason(batch)).filter(F.col("reason").isNotNull())


def _last_id(table: DataFrame | None) -> int:
    return (table.agg(F.max("id")).first()[0] or 0) if table is not None else 0


def new_documents(
    batch: DataFrame, after: int = 0, order_by: list[Column] | None = None, refuse: bool = True
) -> DataFrame:
    """Rows of the documents table for a valid batch, with dense ids above ``after``.

    One bad row fails the batch, as nothing of it is stored. Without ``refuse``, for rows that are
    stored already, it is a warning, and bad rows are numbered like the others. Rows are numbered in
    the order given; ``created_at`` is kept where the batch has one.
    """
    columns = set(batch.columns)
    place = [c for c in ("file", "index") if c in columns]
    bad = rejected_rows(batch).select(*place, "reason").orderBy(*place or ["reason"]).first()
    if bad:
        where = f"docs[{bad['index']}]: " if "index" in columns else ""
        if refuse:
            raise ValueError(where + bad["reason"])
        warnings.warn(where + bad["reason"], stacklevel=2)
    external = F.col("external_id") if "external_id" in columns else F.lit(None)
    created = F.col("created_at") if "created_at" in columns else F.lit(None)
    rows = batch.select(
        external.cast("string").alias("external_id"),
        "title",
        "body",
        F.coalesce(created.cast("timestamp"), F.current_timestamp()).alias("created_at"),
        *place,
    )
    if order_by is None and {"file", "index"} <= columns:
        order_by = [F.col("file"), F.col("index")]
    return with_dense_ids(rows, after, order_by).select(*schemas.DOCUMENTS.names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    table = _existing(spark, path)
    if table is None:
        raise FileNotFoundError(f"no documents table at {path}")
    return table


def insert_documents(
    spark: SparkSession, path: str, batch: DataFrame, order_by: list[Column] | None = None
) -> DataFrame:
    """Append a batch to the documents table at ``path``; returns the new rows.

    One writer at a time: the ids continue after the largest stored one. Sort the result by id
    for the order of insertion.
    """
    rows = new_documents(batch, _last_id(_existing(spark, path)), order_by)
    folder = versions.current(spark, path)
    if folder is not None:
        rows.write.mode("append").parquet(folder)
    else:
        with versions.replacing(spark, path) as folder:
            rows.write.parquet(folder)
    return rows


def insert_document(spark: SparkSession, path: str, title, body, created_at=None) -> DataFrame:
    """``insert_documents`` of a single row."""
    for name, value in (("title", title), ("body", body)):
        if not isinstance(value, str):
            raise ValueError(f"{name} is required")
    row = spark.createDataFrame(
        [(title, body, created_at)], "title string, body string, created_at timestamp"
    )
    return insert_documents(spark, path, row)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    folder = versions.current(spark, path)
    return spark.read.schema(schemas.DOCUMENTS).parquet(folder) if folder else None


def upsert_rejects(batch: DataFrame) -> DataFrame:
    """The rows of an upsert that the table's constraints refuse, with their ``reason``."""
    reason = F.when(F.col("title").isNull(), "title is null").when(
        F.col("body").isNull(), "body is null"
    )
    return batch.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def upsert(
    existing: DataFrame, batch: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The documents table after upserting ``batch(external_id, title, body)``.

    A known ``external_id`` gets the new title and body and keeps its id and creation time; the
    other rows are inserted with new ids. A null title or body fails the batch, and so does a
    key twice in it. A null key matches nothing, so those rows stay out of the joins; they are
    numbered by their content, which spreads them over the tasks.
    """
    batch = batch.select("external_id", "title", "body")
    refused = upsert_rejects(batch).first()
    if refused:
        raise ValueError(f"external_id {refused['external_id']}: {refused['reason']}")
    repeated = (
        batch.filter(F.col("external_id").isNotNull())
        .groupBy("external_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .limit(1)
        .collect()
    )
    if repeated:
        raise ValueError(f"external_id twice in one batch: {repeated[0]['external_id']}")

    keyed = existing.filter(F.col("external_id").isNotNull())
    unkeyed = existing.filter(F.col("external_id").isNull())
    changes = batch.filter(F.col("external_id").isNotNull()).select(
        "external_id", F.col("title").alias("_title"), F.col("body").alias("_body")
    )
    if fits_broadcast(changes, broadcast_bytes):
        # A batch small against the table: the table does not move.
        changes = F.broadcast(changes)
        known = keyed.join(changes, "external_id", "left_semi").select("external_id")
    else:
        known = keyed.select("external_id")
    updated = keyed.join(changes, "external_id", "left").select(
        "id",
        "external_id",
        F.coalesce("_title", "title").alias("title"),
        F.coalesce("_body", "body").alias("body"),
        "created_at",
    )
    inserted = (
        batch.filter(F.col("external_id").isNotNull())
        .join(known, "external_id", "left_anti")
        .unionByName(batch.filter(F.col("external_id").isNull()))
    )
    new_rows = with_dense_ids(
        inserted.select("*", F.current_timestamp().alias("created_at")),
        _last_id(existing),
        [F.col("external_id"), F.xxhash64("title", "body")],
    )
    return updated.unionByName(unkeyed.select(*updated.columns)).unionByName(
        new_rows.select(*updated.columns)
    )


def upsert_documents(spark: SparkSession, path: str, batch: DataFrame) -> None:
    """``upsert`` into the table at ``path``; one writer at a time.

    The new table is the next version beside the old one, which goes only when it is complete.
    """
    existing = _existing(spark, path)
    if existing is None:
        existing = spark.createDataFrame([], schemas.DOCUMENTS)
    with versions.replacing(spark, path) as folder:
        upsert(existing, batch).write.parquet(folder)


def reset(spark: SparkSession, *tables: tuple[str, object]) -> None:
    """Empty tables given as ``(path, schema)``; ids start at 1 again.

    An index has ``index_store.reset``.
    """
    for path, schema in tables:
        with versions.replacing(spark, path) as folder:
            spark.createDataFrame([], schema).write.parquet(folder)
