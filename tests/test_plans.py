"""Physical plans: what is pushed down, what shuffles."""

import pytest
from pyspark.sql import functions as F

from termloom.operators import search, stats
from termloom.operators.postings import build_postings
from termloom.sources import index_store
from termloom.sources.corpus import corpus


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index(spark, random_docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "index")
    index_store.rebuild_index(random_docs, path)
    return index_store.read_postings(spark, path)


@pytest.fixture(scope="module")
def stored_docs(spark, random_docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "docs")
    random_docs.withColumn("unused", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_postings_do_not_shuffle(stored_docs):
    text = plan(build_postings(corpus(stored_docs, start_after=10)))
    assert "Exchange" not in text
    assert "GreaterThan(doc_id,10)" in text and "unused" not in text


def test_one_term_does_not_shuffle(index):
    text = plan(search.matching_docs(index, ["hot"]))
    assert "Exchange" not in text and "EqualTo(term,hot)" in text and "tf" not in text


@pytest.mark.parametrize("mode", ["and", "or"])
def test_boolean_search_shuffles_once(index, mode):
    text = plan(search.matching_docs(index, ["hot", "w1"], mode))
    assert text.count("Exchange") == 1 and "In(term, [hot,w1])" in text


def test_limits_are_pruned_per_task(index):
    assert "TakeOrderedAndProject" in plan(search.search(index, "hot", limit=5))
    assert "WindowGroupLimit" in plan(stats.term_sample(index))


def test_verified_topk_reads_only_its_documents(index, stored_docs):
    documents = stored_docs.select("doc_id", "unused")
    text = plan(search.term_topk(index, documents, "hot", 3, verified=True))
    assert "In(doc_id, [" in text and "BroadcastHashJoin" in text
