"""Headline timings: prints one JSON line.

Reads ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``. An index is built once; the searches run
against it, as they would in use. Each entry is the median of its repeats after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from termloom import catalog
from termloom.functions.snippet import snippet
from termloom.functions.text import TokenOptions, title_and_body
from termloom.operators import batch, latency, quality, search, stats
from termloom.operators.postings import build_postings, to_blocks
from termloom.session import build_session
from termloom.sources import generator, index_store
from termloom.sources.corpus import read_corpus

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
# Warm-ups and repeats of the term queries, as published for them.
TERM_RUNS = (5, 30)


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="bench-")
    docs = read_corpus(spark, f"{SF_DIR}/documents.parquet")
    sources = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source")
    builds = iter(range(1000))

    def rebuild() -> str:
        path = f"{scratch}/index-{next(builds)}"
        index_store.rebuild_index(docs, path)
        return path

    index = index_store.read_postings(spark, rebuild())
    # The synthetic corpus with its title-and-body index, as in the term-query baseline.
    generated = generator.generate_range(spark, 10_000, "seed").withColumnRenamed(
        "number", "doc_id"
    )
    generated.write.parquet(f"{scratch}/generated")
    generated = spark.read.parquet(f"{scratch}/generated")

    def rebuild_generated() -> str:
        path = f"{scratch}/generated-index-{next(builds)}"
        text = title_and_body(F.col("title"), F.col("body")).alias("text")
        index_store.rebuild_index(
            generated.select("doc_id", text), path, options=TokenOptions(mode="ascii")
        )
        return path

    generated_index = index_store.read_postings(spark, rebuild_generated())
    external = generated.select("doc_id", "external_id")
    queries = catalog.benchmark_queries(spark, SF_DIR)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select(
        F.col("event_type").alias("term"), F.col("value").alias("dur_ms")
    )
    words = F.array(F.lit("the"), F.lit("und"))
    work = {
        "index_rebuild": rebuild,
        "generated_index_rebuild": rebuild_generated,
        **{
            f"term_query_{term}": lambda term=term: search.term_topk(
                generated_index, external, term, 10
            ).collect()
            for term in ("alpha", "beta", "gamma", "w10", "w999", "w1500")
        },
        "postings_unicode": lambda: consume(build_postings(docs)),
        "postings_simple": lambda: consume(build_postings(docs, TokenOptions(mode="simple"))),
        "postings_ascii": lambda: consume(catalog.postings_ascii(spark, SF_DIR)),
        "tokens_fold": lambda: consume(build_postings(docs, TokenOptions(ascii_fold=True))),
        "posting_blocks": lambda: consume(to_blocks(index)),
        "term_topk": lambda: search.term_topk(index, sources, "the", 10).collect(),
        "term_topk_verified": lambda: search.term_topk(
            index, sources, "the", 10, verified=True
        ).collect(),
        "search_and": lambda: consume(search.search(index, "the of")),
        "search_or": lambda: consume(search.search(index, "the of", "or")),
        "search_limit": lambda: search.search(index, "the of", limit=10).collect(),
        "search_response": lambda: consume(search.search_response(index, "the of", docs=docs)),
        "batch_search": lambda: consume(batch.batch_hits(index, batch.prepare(queries))),
        "snippets": lambda: consume(docs.select("doc_id", snippet(F.col("text"), words))),
        "corpus_stats": lambda: stats.corpus_stats(docs, index).collect(),
        "index_checks": lambda: quality.index_checks(index).collect(),
        "index_fingerprint": lambda: quality.fingerprint(index).collect(),
        "latency_summary": lambda: latency.latency_summary(events).collect(),
        "upserted_documents": lambda: consume(catalog.upserted_documents(spark, SF_DIR)),
        "inserted_documents": lambda: consume(catalog.inserted_documents(spark, SF_DIR)),
        "generated_corpus": lambda: consume(generator.generate_range(spark, 10_000)),
    }
    timings: dict[str, float] = {}
    # p50, p95, min and max by nearest rank.
    spreads: dict[str, list[float]] = {}
    for name, run in work.items():
        warm_ups, repeats = TERM_RUNS if name.startswith("term_query_") else (1, REPEATS)
        for _ in range(warm_ups):
            run()
        samples = []
        for _ in range(repeats):
            start = time.perf_counter()
            run()
            samples.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(samples), 3)
        if repeats >= 20:
            samples.sort()
            p50, p95 = (samples[-(-len(samples) * p // 100) - 1] for p in (50, 95))
            spreads[name] = [round(v, 3) for v in (p50, p95, samples[0], samples[-1])]
        print(f"{timings[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "term_query_p50_p95_min_max": spreads,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
