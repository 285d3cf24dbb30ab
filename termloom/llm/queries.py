"""The corpus operators as named queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    decontamination,
    exact_dedup,
    language,
    licences,
    merkle,
    near_dedup,
    packing,
    pii,
    prefix_trie,
    secrets,
    sql,
    token_counts,
    toxicity,
    warc,
)
from termloom.llm.common import ROW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    return Path(public_tokenizers.path(name)).read_text()


def _remainder(folds: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def _fold():
    return _remainder(3)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learns from the rows whose fold is not 1."""
    return toxicity.train(docs, labels.filter(_fold() != 1))


@query
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(_fold() == 1, F.lit(False)).alias("held_out")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out, "score", "predicted", "evidence")


@query
def op4_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents")).drop(*ROW)


@query
def op6_warc(spark, sf_dir):
    folder, manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_archives(spark, folder, manifest, with_html=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents")).drop(*ROW)


@query
def op8_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"))


@query
def op5_exact_dedup(spark, sf_dir):
    decided = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return decided.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        exact_dedup.is_kept().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query
def op1_decontamination(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.overlaps(docs, benchmark)
    return found.select("doc_id", "item_id", "start", "agreeing", "covered")


@query
def op2_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.train(docs))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op10_near_dedup(spark, sf_dir):
    classes = near_dedup.classify(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "keep")


@query
def op11_prefix_trie(spark, sf_dir):
    nodes, _ = prefix_trie.trie(table(spark, sf_dir, "conversations"))
    return nodes.drop("turn_ref")


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.without_newlines())


@query
def op13_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(_remainder(4) != 2))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score")


ORACLES: dict[str, str] = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
                   octet_length(encode(coalesce(html, ''))) AS size
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest)
                      ELSE page_id END AS first_id
            FROM p
        )
        SELECT page_id, size AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op4_licences": sql.licences(),
    "op11_prefix_trie": sql.PREFIX_TRIE,
    "op12_merkle_manifest": sql.MERKLE,
}
