"""The pipeline's stages, each against brute force on its own input."""

import random

import corpus_pipeline
import pyarrow as pa
from test_corpus_operators import brute_classes, check_packing, vocabulary

from termloom.llm import common, near_dedup
from termloom.plans.staging import small_batches, stage


def tables(spark, folder):
    rng = random.Random(21)
    words, bad = vocabulary(rng, 2000), ["grobian", "lumpen", "schuft"]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(5)]
    docs, labels = [], []
    for i in range(400):
        found = rng.choices(words, k=70)
        if i % 5 == 0:
            found[3:5] = rng.sample(bad, 2)
        if i % 7 == 1:
            found[20:20] = items[i % 5][1].split()
        docs.append((i, " ".join(found)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 1, int(i % 5 == 0)))
    clean = [t for i, t in docs if i % 5 and i % 7 != 1]
    docs += [(400 + i, t) for i, t in enumerate(clean[:20])]
    for i, text in enumerate(clean[10:40]):
        near = text.split()
        near[30] = "changed"
        docs.append((500 + i, " ".join(near)))
    docs += [(600, None), (601, ""), (None, clean[50])]
    for name, rows, schema in (
        ("documents", [(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars int"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return items


def test_pipeline_stages(spark, tmp_path):
    items = tables(spark, tmp_path)
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in read.collect()]
        out = f"{tmp_path}/{name}"
        stage(spark, read, str(tmp_path)).write.parquet(out)
        after = spark.read.parquet(out)
        if name == "packing":
            break
        assert after.columns == read.columns
        kept[name] = (before, [(r.doc_id, r.text) for r in after.collect()])
        read = after
    before, after = kept["toxicity"]
    assert {i for i, _ in after} == {i for i, _ in before if not (i is not None and i < 400 and i % 5 == 0)}
    before, after = kept["exact_dedup"]
    best = {}
    for i, t in before:
        t = t or ""
        best[t] = i if t not in best else max(best[t], i, key=lambda x: -1 if x is None else x)
    assert sorted(map(str, (i for i, _ in after))) == sorted(map(str, best.values()))
    before, after = kept["near_dedup"]
    rows = sorted(((i, t) for i, t in before), key=lambda r: (r[0] is None, r[0] or 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    classes = brute_classes(rows, near_dedup.inverse_frequencies(frame))
    assert {i for i, _ in after} == set(classes.values())
    assert len(before) - len(after) >= 20
    before, after = kept["decontamination"]
    leaks = {i for i, t in before if any(text in (t or "") for _, text in items)}
    assert leaks and {i for i, _ in after} == {i for i, _ in before} - leaks
    check_packing(spark.read.parquet(f"{tmp_path}/packing").collect(), [(i, t or "") for i, t in after])


def test_leaks_in_a_long_document_full_of_hits(spark, tmp_path):
    # Rows of hits with all words of the document would take some 29 GB.
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, " ".join([text] * 500), "en"), (2, "nothing here", "en"), (None, f"so {text}", None), (3, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spark.createDataFrame([(i, text) for i in range(20)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    kept = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "nothing here", "en"), (3, None, "de")]


def test_dropped_rows_are_found_once(spark):
    docs = stage(spark.createDataFrame([(i, f"t{i}") for i in range(10)], "doc_id long, text string"), "docs")
    placed, seen = common.located(docs), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    dropped = placed.filter("doc_id < 3").select(*common.ROW).mapInArrow(count, "_file long, _at long")
    kept = common.without(placed, dropped)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(3, 10))
    assert seen.value == 3


def test_near_dedup_classes_are_found_once(spark, monkeypatch):
    measured = []

    def fits(frame):
        measured.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return True

    monkeypatch.setattr(near_dedup, "fits_broadcast", fits)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words)) for i in range(3)] + [(3, " ".join(words[:30] + ["x"] + words[31:]))]
    kept = near_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [0]
    # What is measured before it is joined is read from a written table.
    assert measured and not any("Join" in plan or "Aggregate" in plan for plan in measured)


def test_workers_keep_one_operators_tables():
    made = common.kept("a", "table", list)
    run = common.giving_back(lambda batches: batches, "a")
    assert list(run([1, 2])) == [1, 2] and common.kept("a", "table", list) is made
    assert list(common.giving_back(lambda batches: batches)([3])) == [3]
    assert common.kept("a", "table", list) is not made


def test_batches_of_texts_are_small(spark):
    docs, before = spark.range(0, 5000, 1, 1), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": [len(batch)]})

    with small_batches(spark):
        assert {r.id for r in docs.mapInArrow(sizes, "id long").collect()} == {1000}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
