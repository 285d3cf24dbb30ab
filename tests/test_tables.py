import json
import math
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termloom import catalog, schemas
from termloom.functions.text import TokenOptions
from termloom.operators import latency, lookup, quality
from termloom.operators.postings import build_postings, to_blocks
from termloom.plans import numbering
from termloom.plans.joins import BROADCAST_BYTES
from termloom.sources import documents as store
from termloom.sources import generator, index_json, index_store
from termloom.sources.corpus import corpus, literal_corpus
from termloom.streaming.incremental import follow_corpus


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def write(path, value):
    path.write_text(json.dumps(value), encoding="utf-8")


def test_literal_corpus(spark):
    rows = literal_corpus(spark, [(0, "zero"), (1, None), (2, 7)]).collect()
    assert [(r["doc_id"], r["text"]) for r in rows] == [(0, "zero"), (1, ""), (2, "")]
    for bad in ([(-1, "x")], [("1", "x")], [(True, "x")]):
        with pytest.raises(TypeError):
            literal_corpus(spark, bad)
    with pytest.raises(ValueError):
        literal_corpus(spark, [(1, "a"), (1, "b")])


def test_corpus_columns(spark):
    table = spark.createDataFrame([(1, None, "x"), (2, "b", "y")], "k int, content string, t string")
    rows = corpus(table, "k", "content", ("t",), start_after=0).collect()
    assert [tuple(r) for r in rows] == [(1, "", "x"), (2, "b", "y")]
    assert corpus(table, "k", "content", start_after=1).count() == 1


def test_batch_files(spark, tmp_path):
    write(tmp_path / "a.json", {"documents": [{"title": " a ", "body": "b"}, {"title": 3, "body": "b"}]})
    write(tmp_path / "b.json", {"docs": [{"title": "c", "content": "d", "createdAt": "2024-01-02T03:04:05Z"}]})
    write(tmp_path / "c.json", [{"title": "e", "body": None, "content": "f", "created_at": "2023-01-01T00:00:00Z"}, "text", None])
    write(tmp_path / "d.json", {"documents": []})
    rows = store.read_batches(spark, str(tmp_path)).orderBy("file", "index").collect()
    assert [(r["index"], r["is_object"], r["title"], r["body"]) for r in rows] == [
        (0, True, " a ", "b"),
        (1, True, None, "b"),
        (0, True, "c", "d"),
        (0, True, "e", "f"),
        (1, False, None, None),
        (2, False, None, None),
    ]
    assert [r["created_at"].year if r["created_at"] else None for r in rows] == [
        None, None, 2024, 2023, None, None,
    ]
    rejected = store.rejected_rows(store.read_batches(spark, str(tmp_path)))
    assert sorted(r["reason"] for r in rejected.collect()) == [
        "must be an object", "must be an object", "title is required",
    ]


def test_ingest(spark, tmp_path):
    write(tmp_path / "cli.json", {"documents": [
        {"title": f"cli doc {i + 1}", "body": f"cli body {i + 1} - quick brown fox {i % 5}"} for i in range(20)]})
    write(tmp_path / "http.json", {"documents": [
        {"title": f"http doc {i + 1}", "body": f"http body {i + 1} - cats and dogs {i % 7}"} for i in range(20)]})
    path = str(tmp_path / "table")
    first = store.insert_documents(spark, path, store.read_batches(spark, str(tmp_path / "cli.json")))
    assert [(r["id"], r["title"]) for r in first.orderBy("id").collect()] == [
        (i + 1, f"cli doc {i + 1}") for i in range(20)
    ]
    second = store.insert_documents(spark, path, store.read_batches(spark, str(tmp_path / "http.json")))
    assert [r["id"] for r in second.orderBy("id").collect()] == list(range(21, 41))
    table = store.read_documents(spark, path)
    assert table.count() == 40
    checks = quality.missing_fields(table, "id", "title", "body", "created_at").collect()
    assert all(r["violations"] == 0 for r in checks)
    one = store.insert_document(spark, path, " kept ", "body").first()
    assert (one["id"], one["title"]) == (41, " kept ")
    for title, body in (("", "b"), ("t", "  ﻿"), (None, "b"), ("t", 5)):
        with pytest.raises(ValueError, match="required"):
            store.insert_document(spark, path, title, body)
    assert store.read_documents(spark, path).count() == 41
    store.reset(spark, (path, schemas.DOCUMENTS))
    assert store.read_documents(spark, path).count() == 0
    assert store.insert_document(spark, path, "t", "b").first()["id"] == 1


def test_a_bad_row_fails_the_batch(spark, tmp_path):
    write(tmp_path / "bad.json", [{"title": "a", "body": "b"}, {"title": "a", "body": " "}])
    path = tmp_path / "table"
    with pytest.raises(ValueError, match=r"docs\[1\]: body is required"):
        store.insert_documents(spark, str(path), store.read_batches(spark, str(tmp_path / "bad.json")))
    assert not path.exists()
    empty = spark.createDataFrame([], "title string, body string")
    assert store.new_documents(empty).count() == 0


def test_inserted_documents_number_blank_rows(spark, tmp_path):
    rows = [(3, "", "src1"), (0, "a b", "src1"), (2, None, "src2"), (5, "c", None), (4, " \n", " "), (1, "d", "src3")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    with pytest.warns(UserWarning, match="is required"):
        got = catalog.inserted_documents(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], r["external_id"], r["title"], r["body"]) for r in got] == [
        (1001 + i, f"doc_{i:08d}", source, text) for i, text, source in sorted(rows, key=lambda row: row[0])
    ]
    batch = table.selectExpr("source AS title", "text AS body")
    with pytest.raises(ValueError, match="is required"):
        store.new_documents(batch)


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, -1])
def test_upsert(spark, broadcast_bytes):
    existing = spark.createDataFrame(
        [(1, "a", "t1", "b1"), (2, None, "t2", "b2"), (7, "c", "t3", "b3")],
        "id long, external_id string, title string, body string",
    ).withColumn("created_at", F.lit("2020-01-01").cast("timestamp"))
    batch = spark.createDataFrame(
        [("c", "new3", "newb3"), ("x", "tx", "bx"), (None, "tn", "bn")],
        "external_id string, title string, body string",
    )
    rows = store.upsert(existing, batch, broadcast_bytes).orderBy("id").collect()
    assert [(r["id"], r["external_id"], r["title"]) for r in rows] == [
        (1, "a", "t1"), (2, None, "t2"), (7, "c", "new3"), (8, None, "tn"), (9, "x", "tx"),
    ]
    assert [r["created_at"].year == 2020 for r in rows] == [True] * 3 + [False] * 2
    with pytest.raises(ValueError, match="twice"):
        store.upsert(existing, batch.union(batch))


def test_upsert_table_and_seed_ids(spark, tmp_path):
    path = str(tmp_path / "docs")
    seeds = spark.createDataFrame(
        [
            ("seed_1", "doc 1", "the quick brown fox jumps over the lazy dog"),
            ("seed_2", "doc 2", "the quick red fox jumps over the sleeping cat"),
            ("seed_3", "doc 3", "cats and dogs can be friends"),
        ],
        "external_id string, title string, body string",
    )
    for _ in range(2):
        store.upsert_documents(spark, path, seeds)
    table = store.read_documents(spark, path)
    expected = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert quality.id_differences(table, expected).count() == 0
    other = spark.createDataFrame([(1,), (2,), (4,)], "id long")
    assert sorted(tuple(r) for r in quality.id_differences(table, other).collect()) == [
        (3, "unexpected"), (4, "missing"),
    ]


def test_index_store(spark, random_docs, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        index_store.read_postings(spark, path)
    index_store.rebuild_index(random_docs.filter("doc_id < 100"), path, rows_per_file=200)
    index_store.extend_index(random_docs.filter("doc_id < 300"), path)
    index_store.extend_index(random_docs, path)
    assert same(index_store.read_postings(spark, path), build_postings(random_docs))
    stats = index_store.read_stats(spark, path).first()
    assert (stats["doc_count"], stats["max_doc_id"]) == (600, 599)
    assert stats["posting_count"] == build_postings(random_docs).count()
    index_store.rebuild_index(random_docs.limit(10), path, options=TokenOptions(mode="simple"))
    assert index_store.read_stats(spark, path).first()["doc_count"] == 10
    index_store.rebuild_index(random_docs.limit(0), path)
    assert index_store.read_postings(spark, path).count() == 0


def test_a_frequent_term_is_split_over_files(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('hot ', id) AS text")
    path = str(tmp_path / "index")
    index_store.rebuild_index(docs, path, rows_per_file=500)
    hot = index_store.read_postings(spark, path).filter("term = 'hot'")
    assert hot.count() == 4000
    files = list((tmp_path / "index").glob("version=*/postings/**/*.parquet"))
    assert files
    for file in files:
        rows = pq.read_table(file, columns=["term", "doc_id"]).to_pylist()
        keys = [(row["term"], row["doc_id"]) for row in rows]
        assert keys == sorted(keys)
    assert hot.select(F.input_file_name()).distinct().count() > 3


def test_json_export(spark, random_docs, tmp_path):
    postings = build_postings(random_docs)
    paths = [str(tmp_path / name) for name in ("one", "two")]
    for path, frame in zip(paths, (postings, postings.repartition(5))):
        index_json.write_index_json(frame, path, 600, block_docs=100)
    assert same(index_json.read_index_json(spark, paths[0]), postings)
    assert index_json.read_doc_count(spark, paths[0]).first()["doc_count"] == 600

    def lines(path):
        files = sorted((tmp_path / path / "postings").glob("*.json"))
        return "".join(f.read_text(encoding="utf-8") for f in files)

    assert lines("one") == lines("two") != ""


def test_whole_index_file(spark, tmp_path):
    write(tmp_path / "index.json", {"docCount": 3, "postings": {
        "fox": [{"docId": 1, "tf": 1}, {"docId": "2", "tf": 4}, {"docId": 2, "tf": 2}],
        "bad": [{"docId": -1, "tf": 1}, {"docId": 1.5, "tf": 1}, {"docId": "x", "tf": 1}, {"docId": 5, "tf": 0}]}})
    rows = index_json.read_whole_index(spark, str(tmp_path / "index.json")).collect()
    assert sorted(tuple(r) for r in rows) == [("bad", 5, 0), ("fox", 1, 1), ("fox", 2, 2)]
    assert index_json.read_whole_doc_count(spark, str(tmp_path / "index.json")).first()[0] == 3
    write(tmp_path / "empty.json", {})
    assert index_json.read_whole_index(spark, str(tmp_path / "empty.json")).count() == 0
    assert index_json.read_whole_doc_count(spark, str(tmp_path / "empty.json")).first()[0] == 0


def test_a_failed_replacement_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.range(50).selectExpr("'k' || id AS external_id", "'t' AS title", "'b' AS body")
    store.upsert_documents(spark, path, rows)
    broken = rows.withColumn(
        "body", F.when(F.col("external_id") == "k7", F.raise_error(F.lit("torn"))).otherwise("n")
    )
    with pytest.raises(Exception, match="torn"):
        store.upsert_documents(spark, path, broken)
    table = store.read_documents(spark, path)
    assert table.count() == 50 and table.filter("body = 'b'").count() == 50
    index = str(tmp_path / "index")
    docs = spark.range(20).selectExpr("id AS doc_id", "'word ' || id AS text")
    index_store.rebuild_index(docs, index)
    torn = docs.withColumn("text", F.when(F.col("doc_id") == 3, F.raise_error(F.lit("torn"))).otherwise("x"))
    with pytest.raises(Exception, match="torn"):
        index_store.rebuild_index(torn, index)
    assert index_store.read_postings(spark, index).filter("term = 'word'").count() == 20
    index_store.rebuild_index(docs.limit(5), index)
    assert len(list((tmp_path / "index").iterdir())) == 1


def test_upsert_refuses_nulls_and_spreads_unkeyed_rows(spark):
    existing = spark.createDataFrame([], schemas.DOCUMENTS)
    batch = spark.createDataFrame([("a", None, "b")], "external_id string, title string, body string")
    with pytest.raises(ValueError, match="title is null"):
        store.upsert(existing, batch)
    unkeyed = spark.range(20_000).selectExpr(
        "CAST(NULL AS STRING) AS external_id", "'t' || id AS title", "'b' AS body"
    )
    rows = store.upsert(existing, unkeyed)
    assert rows.agg(F.count_distinct("id"), F.max("id")).first() == (20_000, 20_000)


def test_unreadable_times_are_rejected(spark, tmp_path):
    write(tmp_path / "b.json", [{"title": "a", "body": "b", "createdAt": "soon"},
                                {"title": "a", "body": "b", "created_at": None},
                                {"title": "a", "body": "b", "created_at": "2024-01-02T03:04:05Z"}])
    rows = store.read_batches(spark, str(tmp_path / "b.json"))
    bad = store.rejected_rows(rows).collect()
    assert [(r["index"], r["reason"]) for r in bad] == [(0, "created_at is not a time")]
    write(tmp_path / "odd.json", {"documents": "none"})
    with pytest.raises(Exception, match="must be an array in .*odd.json"):
        store.read_batches(spark, str(tmp_path / "odd.json")).collect()


def test_every_writer_keeps_the_others_documents(spark, tmp_path):
    source, index, checkpoint = (str(tmp_path / n) for n in ("docs", "index", "check"))
    docs = spark.range(400).selectExpr("id AS doc_id", "'word w' || id AS text")

    def arrive(condition):
        docs.filter(condition).coalesce(1).write.mode("append").parquet(source)
        follow_corpus(spark, source, index, checkpoint, docs.schema).awaitTermination()

    index_store.rebuild_index(docs.filter("doc_id < 10"), index)
    arrive("doc_id BETWEEN 5 AND 99")
    index_store.extend_index(docs.filter("doc_id < 250"), index)
    arrive("doc_id BETWEEN 200 AND 399")
    postings = index_store.read_postings(spark, index)
    assert same(postings, build_postings(docs))
    assert index_store.read_stats(spark, index).first()["doc_count"] == 400
    index_store.reset(spark, index)
    assert index_store.read_postings(spark, index).count() == 0
    index_store.extend_index(docs, index)
    assert same(index_store.read_postings(spark, index), build_postings(docs))


def test_streaming_index(spark, random_docs, tmp_path):
    source, index, checkpoint = (str(tmp_path / n) for n in ("docs", "index", "check"))
    schema = random_docs.schema
    for part in ("doc_id < 200", "doc_id >= 200"):
        random_docs.filter(part).coalesce(1).write.mode("append").parquet(source)
        follow_corpus(spark, source, index, checkpoint, schema).awaitTermination()
        # Nothing new: nothing is indexed twice.
        follow_corpus(spark, source, index, checkpoint, schema).awaitTermination()
    assert same(index_store.read_postings(spark, index), build_postings(random_docs))
    assert index_store.read_stats(spark, index).first()["doc_count"] == 600


def test_generator_and_determinism(spark):
    docs = generator.generate_range(spark, 25, "smoke").orderBy("number").collect()
    again = generator.generate_range(spark, 25, "smoke").repartition(7).orderBy("number").collect()
    assert docs == again
    assert docs != generator.generate_range(spark, 25, "other").orderBy("number").collect()
    for i, row in enumerate(docs):
        assert row["external_id"] == f"doc_{i:08d}"
        title, body = row["title"].split(), row["body"].split()
        assert 4 <= len(title) <= 10 and 60 <= len(body) <= 180
        (topic,) = {w for w in title if not w.startswith("w")}
        assert topic in generator.TOPICS and 1 <= body.count(topic) <= 3
        assert all(w == topic or 0 <= int(w[1:]) < 2000 for w in title + body)
    many = generator.generate_range(spark, 2000)
    words = many.select(F.explode(F.split("body", " ")).alias("w")).distinct().count()
    assert words == 2000 + len(generator.TOPICS)
    with pytest.raises(ValueError):
        generator.generate_range(spark, 0)


def test_index_checks_query_sees_every_document(spark, tmp_path):
    from termloom import catalog

    # Only the last document, beyond id 500, holds the term.
    rows = [(i, f"the text of {i}") for i in range(1, 700)] + [(700, "nosuchterm")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["rule"]: r["violations"] for r in catalog.index_checks(spark, str(tmp_path)).collect()}
    assert found["expected_term:nosuchterm"] == 0 and found["doc_count"] == 1


def test_index_checks(spark):
    docs = generator.generate_range(spark, 25, "smoke").select(
        (F.col("number") + 1).alias("doc_id"), F.col("body").alias("text")
    )
    postings = build_postings(docs)
    sound = quality.index_checks(postings, docs, 1, generator.TOPICS, 25).collect()
    assert len(sound) == 10 and all(r["violations"] == 0 for r in sound)
    assert all(r["violations"] == 0 for r in quality.block_checks(to_blocks(postings)).collect())
    broken = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 0), ("a", 1, 3), (None, 2, 1)], "term string, doc_id long, tf int"
    )
    found = {r["rule"]: r["violations"] for r in quality.index_checks(broken, docs, 1, ("b",), 24).collect()}
    assert found == {
        "term": 1, "doc_id": 1, "tf": 1, "duplicate_posting": 1, "expected_term:b": 1, "doc_count": 1,
    }
    blocks = spark.createDataFrame(
        [("a", 0, [(2, 1), (1, 1)]), ("b", 0, [])], schemas.POSTING_BLOCKS
    )
    assert {r["rule"]: r["violations"] for r in quality.block_checks(blocks).collect()} == {
        "empty_block": 1, "ascending": 1,
    }


def test_fingerprint(random_docs):
    postings = build_postings(random_docs)
    prints = [quality.fingerprint(p).first() for p in (postings, postings.repartition(3, "tf"))]
    assert prints[0] == prints[1]
    assert quality.freshness(postings, postings.repartition(3)).first()["fresh"]
    stale = quality.freshness(postings.filter("doc_id < 599"), postings).first()
    assert not stale["fresh"] and stale["stored_postings"] < stale["rebuilt_postings"]


def nearest_rank(values, p):
    values = sorted(values)
    return values[min(max(math.ceil(p / 100 * len(values)) - 1, 0), len(values) - 1)]


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, -1])
def test_latency_summary(spark, broadcast_bytes):
    rng = random.Random(3)
    samples = {"alpha": [rng.random() for _ in range(30)], "one": [4.0], "flat": [1.0] * 50,
               "w10": [float(rng.randint(0, 9)) for _ in range(999)],
               "hot": [rng.gauss(0, 1) for _ in range(20_000)], None: [1.0, 2.0, 3.0]}
    rows = [(term, v) for term, values in samples.items() for v in values] + [("alpha", None)]
    frame = spark.createDataFrame(rows, schemas.SAMPLES).repartition(8)
    got = latency.latency_summary(frame, (1, 50, 95, 100), broadcast_bytes).collect()
    assert len(got) == len(samples)
    for row in got:
        values = samples[row["term"]]
        assert row["n"] == len(values)
        assert (row["min"], row["max"]) == (min(values), max(values))
        for p in (1, 50, 95, 100):
            assert row[f"p{p}"] == nearest_rank(values, p), (row["term"], p)


@pytest.mark.parametrize("limit", [0, 1, 4, 7, 9, 30, 500])
def test_recency_cut_by_hours(spark, monkeypatch, limit):
    monkeypatch.setattr(numbering, "GROUP_LIMIT", 2)
    base = datetime(2024, 5, 1, 12)
    rows = [(i, base + timedelta(minutes=(i * 37) % 400)) for i in range(30)]
    rows += [(100 + i, base) for i in range(8)] + [(200 + i, None) for i in range(5)]
    frame = spark.createDataFrame(rows, "id long, created_at timestamp")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or base, r[0]), reverse=True)[:limit]
    assert [tuple(r) for r in lookup.by_recency(frame, limit).collect()] == want
    assert lookup.by_recency(frame.limit(0), limit).collect() == []
