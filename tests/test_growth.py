"""What must not grow with the tables: shuffles, what one task holds, files and tasks."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from termloom import catalog
from termloom.operators import batch, quality
from termloom.operators.postings import build_postings, sanitize
from termloom.plans import staging
from termloom.plans.order import proven_unique
from termloom.sources import index_json, index_store


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows_of(frame):
    return sorted(tuple(row) for row in frame.collect())


@pytest.fixture(scope="module")
def many_docs(spark):
    return spark.range(4000).selectExpr("id AS doc_id", "concat('hot ', id) AS text")


def test_streamed_index_of_a_folder_of_files(spark, random_docs, tmp_path):
    random_docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.streamed_index(spark, str(tmp_path))
    assert rows_of(got) == rows_of(build_postings(random_docs))


def test_streamed_index_of_one_file(spark, random_docs, tmp_path):
    pq.write_table(random_docs.toArrow(), tmp_path / "documents.parquet")
    got = catalog.streamed_index(spark, str(tmp_path))
    assert rows_of(got) == rows_of(build_postings(random_docs))


def test_small_files_need_no_tasks_of_their_own(spark, many_docs, tmp_path):
    index_store.rebuild_index(many_docs, str(tmp_path / "index"), rows_per_file=500)
    files = list((tmp_path / "index").glob("version=*/postings/**/*.parquet"))
    assert all(pq.read_metadata(file).num_rows <= 500 for file in files)
    assert len(files) >= 16 and len({file.name.split("-")[1] for file in files}) == 1


def test_a_task_sorts_a_bounded_part_of_an_index(spark, many_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(index_store, "ROWS_PER_TASK", 1000)
    path = str(tmp_path / "index")
    index_store.rebuild_index(many_docs, path)
    files = list((tmp_path / "index").glob("version=*/postings/**/*.parquet"))
    assert len(files) == 8
    assert rows_of(index_store.read_postings(spark, path)) == rows_of(build_postings(many_docs))


def test_splits_are_small_only_within_the_block(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with staging.small_splits(spark, 1 << 20):
        assert int(spark.conf.get(key).removesuffix("b")) == 1 << 20
        with staging.small_splits(spark, 1 << 30):
            assert int(spark.conf.get(key).removesuffix("b")) == 1 << 20
    assert spark.conf.get(key) == before


def test_fingerprint_adds_longs(spark, seed_postings):
    found = quality.fingerprint(seed_postings)
    assert "decimal(38,0)" not in plan(found)
    text = F.concat_ws("|", "term", "doc_id", "tf").cast("binary")
    first = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    expected = seed_postings.agg(F.count("*"), F.sum(first).cast("string")).first()
    assert tuple(found.first()) == tuple(expected)
    assert tuple(quality.fingerprint(seed_postings.limit(0)).first()) == (0, "0")


def test_order_proves_that_rows_differ(spark, many_docs, tmp_path):
    path = str(tmp_path / "index")
    index_store.rebuild_index(many_docs, path, rows_per_file=500)
    stored = index_store.read_postings(spark, path)
    assert proven_unique(stored, "term", "doc_id")
    assert not proven_unique(stored.union(stored.limit(1)), "term", "doc_id")
    null = spark.createDataFrame([(None, 1, 1)], stored.schema)
    assert not proven_unique(stored.union(null), "term", "doc_id")
    assert not proven_unique(stored.orderBy(F.rand(1)), "term", "doc_id", most=10)
    assert proven_unique(stored.limit(0), "term", "doc_id")
    # Equal neighbours over the edge of a batch, and equal rows in different tasks.
    twice = spark.range(20_001, numPartitions=1).select(
        F.lit("a").alias("term"), F.when(F.col("id") > 9_999, F.col("id") - 1).otherwise(F.col("id")).alias("doc_id")
    )
    assert not proven_unique(twice, "term", "doc_id")
    assert proven_unique(twice.distinct().repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id"), "term", "doc_id")


def test_duplicates_are_found_without_a_shuffle_of_a_sound_index(spark, many_docs, tmp_path):
    path = str(tmp_path / "index")
    index_store.rebuild_index(many_docs, path)
    stored = index_store.read_postings(spark, path)
    sound = quality.index_checks(stored)
    assert "hashpartitioning(term" not in plan(sound)
    broken = stored.union(stored.filter("doc_id < 3"))
    for frame, expected in ((stored, 0), (broken, 6)):
        found = {row["rule"]: row["violations"] for row in quality.index_checks(frame).collect()}
        assert found["duplicate_posting"] == expected


@pytest.mark.parametrize("kinds", ["long", "int"])
def test_sanitize_does_not_sort(spark, kinds):
    big = 1 << 62 if kinds == "long" else 1 << 30
    rows = [
        ("a", 1, 0, 1, 1.0), ("a", 1, 0, 2, 2.0), ("a", 1, None, 9, 3.0),
        ("b", 1, big, 0, 4.0), ("b", 1, big - 1, 5, 5.0), ("b", 1, -big, 7, 6.0),
        ("c", 1, 3, None, 7.0), ("c", 1, 3, -(1 << 31), 8.0), ("c", -1, 0, 0, 9.0),
        ("d", 1, None, None, 1.0), ("d", 1, None, 0, 2.0), ("e", None, 0, 0, 1.0), ("f", 2, None, None, 3.0),
    ]
    frame = spark.createDataFrame(rows, f"term string, doc_id long, block {kinds}, position int, tf double")
    got = sanitize(frame)
    assert "SortAggregate" not in plan(got)
    expected = [("a", 1, 2), ("b", 1, 4), ("c", 1, 8), ("d", 1, 2), ("f", 2, 3)]
    assert rows_of(got) == expected
    one = sanitize(frame, ("position",))
    assert "SortAggregate" not in plan(one)
    assert rows_of(one) == [("a", 1, 3), ("b", 1, 6), ("c", 1, 8), ("d", 1, 2), ("f", 2, 3)]


def test_damaged_postings_are_cut_once(spark, random_docs, tmp_path):
    random_docs.write.parquet(str(tmp_path / "documents.parquet"))
    text = plan(catalog.sanitized_postings(spark, str(tmp_path)))
    assert "Union" not in text and "SortAggregate" not in text


def test_json_export_is_restored_without_a_shuffle(spark, random_docs, tmp_path):
    path = str(tmp_path / "json")
    index_json.write_index_json(build_postings(random_docs), path, 600, block_docs=100)
    restored = index_json.read_index_json(spark, path)
    assert "Exchange" not in plan(restored)
    assert rows_of(restored) == rows_of(build_postings(random_docs))
    # Of a posting that comes twice, the one in the later block counts.
    again = {"term": "hot", "block": 99, "postings": [{"doc_id": 0, "tf": 77}]}
    (tmp_path / "json" / "postings" / "part-extra.json").write_text(json.dumps(again), encoding="utf-8")
    found = {(row["term"], row["doc_id"]): row["tf"] for row in index_json.read_index_json(spark, path).collect()}
    assert found["hot", 0] == 77 and found["hot", 3] == 1
    assert len(found) == build_postings(random_docs).count()


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_a_batch_writes_only_the_postings_of_its_terms(spark, random_docs, monkeypatch, broadcast_bytes):
    written = []
    monkeypatch.setattr(batch, "stage", lambda frame, label: written.append(label) or staging.stage(frame, label))
    queries = spark.createDataFrame([(1, "hot", "or", None)], "query_id long, q string, mode string, limit long")
    prepared = batch.prepare(queries)
    hits = batch.batch_hits(build_postings(random_docs), prepared, broadcast_bytes)
    assert rows_of(hits) == [(1, i) for i in range(0, 600, 3)]
    assert written == ["queries", "relevant"] if broadcast_bytes else ["queries", "postings", "relevant"]


def test_a_batch_query_writes_no_whole_index(spark, random_docs, tmp_path, monkeypatch):
    random_docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(0, "hot w1"), (1, "w2 w3")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    whole = build_postings(random_docs).count()
    counts = []

    def counting(frame, label, path=None):
        found = staging.stage(frame, label, path)
        counts.append(found.count())
        return found

    monkeypatch.setattr(batch, "stage", counting)
    monkeypatch.setattr(catalog, "stage", counting, raising=False)
    assert catalog.batch_search(spark, str(tmp_path)).count() > 0
    assert max(counts) < whole
