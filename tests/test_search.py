import pytest
from pyspark.sql import functions as F

from termloom.operators import batch, lookup, search, stats
from termloom.operators.postings import build_postings, from_blocks, sanitize, to_blocks
from termloom.plans import joins, numbering


def ids(frame):
    return [row["doc_id"] for row in frame.collect()]


@pytest.mark.parametrize(
    "q,mode,limit,expected",
    [
        ("quick fox", "and", None, [1, 2]),
        ("quick cat", "and", None, [2]),
        ("cat dog", "or", None, [1, 2]),
        ("quick", None, None, [1, 2]),
        ("the the", "and", None, [1, 2]),
        ("fox unknown", "and", None, []),
        ("unknown", "or", None, []),
        ("", "and", None, []),
        ("?!", "or", None, []),
        ("quick", "and", 0, []),
        ("quick", "and", 1.7, [1]),
        ("quick", "AND", "1", [1]),
        ("quick", "", "", [1, 2]),
        ("quick cats", "Or", 99, [1, 2, 3]),
    ],
)
def test_search(seed_postings, q, mode, limit, expected):
    assert ids(search.search(seed_postings, q, mode, limit)) == expected


@pytest.mark.parametrize("limit", [-1, "x", float("nan"), "inf"])
def test_bad_limit(seed_postings, limit):
    with pytest.raises(ValueError, match="invalid_limit"):
        search.search(seed_postings, "fox", "and", limit)


def test_bad_mode(seed_postings):
    with pytest.raises(ValueError, match="invalid_mode"):
        search.search(seed_postings, "fox", "xor")


def test_response(seed_postings, seed_docs):
    row = search.search_response(seed_postings, "quick The quick", limit=1, docs=seed_docs)
    (row,) = row.collect()
    assert row["q"] == "quick The quick" and row["mode"] == "and"
    assert row["terms"] == ["quick", "the", "quick"]
    assert row["count"] == 1 and row["page"] == 0 and row["doc_ids"] == [1]
    assert row["results"][0]["snippet"].startswith("the quick brown")


def test_response_pages_and_empty(seed_postings):
    pages = search.search_response(seed_postings, "quick cats", "or", page_docs=2).collect()
    assert sorted((p["page"], p["doc_ids"], p["count"]) for p in pages) == [
        (0, [1], 3),
        (1, [2, 3], 3),
    ]
    for q in ("", "unknown"):
        (row,) = search.search_response(seed_postings, q).collect()
        assert row["doc_ids"] == [] and row["count"] == 0


def test_response_for_a_missing_document(seed_postings, seed_docs):
    only = seed_docs.filter("doc_id = 1")
    (row,) = search.search_response(seed_postings, "quick", docs=only).collect()
    assert [r["snippet"] is None for r in row["results"]] == [False, True]


def test_set_operations(seed_postings):
    the, cats = (search.matching_docs(seed_postings, [t]) for t in ("quick", "cats"))
    assert sorted(ids(search.union(the, cats))) == [1, 2, 3]
    assert ids(search.intersection(the, cats)) == []


def test_term_topk(spark, seed_postings, seed_docs):
    documents = seed_docs.select("doc_id", F.concat(F.lit("seed_"), "doc_id").alias("external_id"))
    for verified in (False, True):
        top = search.term_topk(seed_postings, documents, "THE", 1, verified).collect()
        assert [(r["external_id"], r["tf"]) for r in top] == [("seed_1", 2)]
    missing = documents.filter("doc_id <> 1")
    assert ids(search.term_topk(seed_postings, missing, "the", 1)) == [2]
    assert ids(search.term_topk(seed_postings, documents, "nosuchterm", 5, True)) == []
    with pytest.raises(ValueError):
        search.term_topk(seed_postings, documents, "the", 0)


def test_lookups(spark, seed_docs, seed_postings):
    documents = seed_docs.withColumnRenamed("doc_id", "id")
    assert lookup.document_by_id(documents, 2).count() == 1
    assert lookup.document_by_id(documents, "2").count() == 1
    for bad in (0, -1, 1.5, "x", None, 99):
        assert lookup.document_by_id(documents, bad).count() == 0
    hits = spark.createDataFrame([(1,), (9,)], "doc_id long")
    assert ids(lookup.existing(hits, seed_docs)) == [1]
    assert {r["doc_id"]: r["text"] is None for r in lookup.with_documents(hits, seed_docs).collect()} == {1: False, 9: True}
    assert lookup.term_postings(seed_postings, "nosuchterm").count() == 0
    terms = spark.createDataFrame([("fox",), ("fox",), ("cats",)], "term string")
    assert lookup.terms_postings(seed_postings, terms).count() == 3


def test_statistics(seed_docs, seed_postings):
    row = stats.corpus_stats(seed_docs, seed_postings).first()
    assert (row["doc_count"], row["term_count"]) == (3, 18)
    sample = stats.term_sample(seed_postings, 2, 1).orderBy("term").collect()
    assert [(r["term"], r["doc_id"]) for r in sample] == [("and", 3), ("be", 3)]


def test_postings_count_occurrences(random_docs):
    expected = {}
    for row in random_docs.collect():
        for word in row["text"].split():
            key = (word, row["doc_id"])
            expected[key] = expected.get(key, 0) + 1
    got = {(r["term"], r["doc_id"]): r["tf"] for r in build_postings(random_docs).collect()}
    assert got == expected
    doubled = build_postings(random_docs.union(random_docs), one_row_per_doc=False).collect()
    assert {(r["term"], r["doc_id"]): r["tf"] for r in doubled} == {
        key: 2 * n for key, n in expected.items()
    }


def test_blocks_hold_every_posting_in_order(random_docs):
    postings = build_postings(random_docs)
    blocks = to_blocks(postings, 50)
    rows = blocks.filter("term = 'hot'").orderBy("block").collect()
    assert [p["doc_id"] for row in rows for p in row["postings"]] == list(range(0, 600, 3))
    assert max(len(row["postings"]) for row in rows) <= 50
    back = from_blocks(blocks).select("term", "doc_id", "tf")
    assert back.exceptAll(postings).count() == 0 and postings.exceptAll(back).count() == 0


def test_sanitize(spark):
    rows = [
        ("a", 1.0, 2.0, 0),
        ("a", 1.0, 5.0, 1),
        ("a", -1.0, 2.0, 2),
        ("a", None, 2.0, 3),
        ("a", 2.5, 2.0, 4),
        ("a", float("nan"), 2.0, 5),
        ("b", 3.0, 0.0, 0),
        ("b", 4.0, None, 1),
        ("b", 5.0, float("inf"), 2),
        ("b", 6.0, -3.0, 3),
        ("b", 0.0, 1.0, 4),
    ]
    frame = spark.createDataFrame(rows, "term string, doc_id double, tf double, position int")
    got = {(r["term"], r["doc_id"]): r["tf"] for r in sanitize(frame, ("position",)).collect()}
    assert got == {
        ("a", 1): 5, ("b", 3): 0, ("b", 4): 0, ("b", 5): 0, ("b", 6): 0, ("b", 0): 1,
    }


BATCH = [
    (1, "hot", "and", None),
    (2, "HOT w1", "and", None),
    (3, "w1 w2 w3", "or", 7),
    (4, "w1 nosuchterm", "and", None),
    (5, "", "or", None),
    (6, "hot w5 w9", "or", None),
    (7, "w1 w1", "and", 3),
    (8, "w2 w4 w1", "xyz", 0),
    (9, "w0 hot", None, -4),
    (10, "w0 w1", "and", 2000),
    (11, None, "and", 1),
    (12, "hot", "or", None),
]


def brute_force(docs):
    texts = {row["doc_id"]: set(row["text"].split()) for row in docs.collect()}
    expected = {}
    for query_id, q, mode, limit in BATCH:
        terms = (q or "").lower().split()
        test = any if mode == "or" else all
        hits = [d for d, words in sorted(texts.items()) if terms and test(t in words for t in terms)]
        expected[query_id] = hits if limit is None else hits[: max(limit, 0)]
    return expected


@pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, -1])
def test_batch_against_brute_force(spark, random_docs, broadcast_bytes):
    postings = build_postings(random_docs)
    queries = spark.createDataFrame(BATCH, "query_id long, q string, mode string, limit long")
    rows = batch.batch_responses(postings, queries, 100, broadcast_bytes).collect()
    got, counts = {}, {}
    for row in sorted(rows, key=lambda r: r["page"]):
        got.setdefault(row["query_id"], []).extend(row["doc_ids"])
        counts[row["query_id"]] = row["count"]
    expected = brute_force(random_docs)
    assert got == expected
    assert counts == {query_id: len(hits) for query_id, hits in expected.items()}
    assert {r["query_id"]: r["terms"] for r in rows}[7] == ["w1", "w1"]


def test_batch_without_limits(spark, random_docs):
    queries = spark.createDataFrame(
        [(1, "hot", "and", None)], "query_id long, q string, mode string, limit long"
    )
    hits = batch.batch_hits(build_postings(random_docs), batch.prepare(queries))
    assert sorted(r["doc_id"] for r in hits.collect()) == list(range(0, 600, 3))


def test_request_checks(spark):
    rows = [
        (1, "a", "AND", "5.9", "and", 5, None),
        (2, "a", None, None, "and", None, None),
        (3, "a", "or", "", "or", None, None),
        (4, "a", "xor", "5", None, 5, "invalid_mode"),
        (5, "a", "", "-1", "and", None, "invalid_limit"),
        (6, "a", "", "abc", "and", None, "invalid_limit"),
        (7, "a", "", "Infinity", "and", None, "invalid_limit"),
        (8, "a", "", "1e400", "and", None, "invalid_limit"),
        (9, "a", "", "1e2", "and", 100, None),
        (10, "a", "", " ", "and", 0, None),
        (11, "a", "", "5d", "and", None, "invalid_limit"),
        (12, "a", "", " 7 ", "and", 7, None),
    ]
    requests = spark.createDataFrame(
        [r[:4] for r in rows], "query_id long, q string, mode string, limit string"
    )
    got = batch.check_requests(requests).orderBy("query_id").collect()
    assert [(r["query_id"], r["mode"], r["limit"], r["reason"]) for r in got] == [
        (r[0], r[4], r[5], r[6]) for r in rows
    ]


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("broadcast_bytes", [joins.BROADCAST_BYTES, -1])
def test_attach_a_hot_key(spark, how, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(joins, "HOT_FRACTION", 10)
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 200)).alias("key"),
        "id",
    ).union(spark.range(5).select(F.lit(None).cast("string"), "id"))
    small = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k7", 3), ("absent", 4), (None, 5)], "key string, v int"
    )
    got = joins.attach(big, small, "key", how, broadcast_bytes)
    expected = big.join(small, "key", how)
    assert got.count() == expected.count() > 1000
    assert got.exceptAll(expected.select(*got.columns)).count() == 0


def test_limit_cut_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(numbering, "CUT_BLOCK", 10)
    monkeypatch.setattr(numbering, "GROUP_LIMIT", 5)
    monkeypatch.setattr(numbering, "GROUP_LIMIT", 5)
    wanted = list(range(0, 500, 7))
    rows = spark.createDataFrame([(i,) for i in reversed(wanted)], "doc_id long")
    for limit in (0, 6, 33, len(wanted), 1000):
        assert ids(numbering.first_by_id(rows, limit)) == wanted[:limit]
    groups = rows.selectExpr("doc_id", "explode(array(1, 2)) AS g").withColumn(
        "limit", F.when(F.col("g") == 1, 12).otherwise(40).cast("long")
    )
    kept = numbering.first_per_group(groups, "g", "limit", 40).collect()
    for group, limit in ((1, 12), (2, 40)):
        assert sorted(r["doc_id"] for r in kept if r["g"] == group) == wanted[:limit]


def test_dense_ids(spark):
    frame = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("v")).repartition(7)
    got = numbering.with_dense_ids(frame, 50, [F.col("v")]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(51, 1051))
    assert [r["v"] for r in got] == list(range(1, 1001))
    assert numbering.with_dense_ids(frame.limit(0), 3).count() == 0
