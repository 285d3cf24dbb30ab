"""Token counts from distinct pre-tokens.

A byte-level BPE merges inside pre-tokens only, so a text's count is the sum over its pre-tokens.
Every document gives its pre-tokens with their frequencies; every distinct pre-token is
counted once and joined to these; the products are summed per document. No ids are kept.

The frequent pre-tokens, at most ``HEAD`` of them found in ``HEAD_DOCS`` documents chosen by
hash, are counted beforehand and sent to every task as a table of bounded size, so their products
are summed inside the document's row. This choice only decides what moves. All other pre-tokens
are shuffled by their text with their document's place and frequency; equal ones then lie together,
each is counted once and meets its frequencies there.

The pre-tokens are cut by the vocabulary's own rule; texts with characters for which the cut below
might differ are cut by the tokenizer. Its special strings count one each, as the library does.

Nulls and repeats: a null text is empty and counts 0; each row gives one row, whatever its id. Extra
columns play no part.
"""

from __future__ import annotations

import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, text_column

HEAD = 200_000
HEAD_DOCS = 10_000
LIMIT = 1024
# Documents per output batch of the first pass.
DOCS_AT_ONCE = 512

# The vocabulary's cutting rule and its special string.
CUTS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
)
SPECIAL = "<|endoftext|>"
# Characters that Python's classes and the tokenizer's may judge apart.
UNSURE = re.compile(
    r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\u200f\u2028-\u202f\u205f-\U0010ffff]"
)


def load(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def pretokens(text: str, tokenizer) -> list[str]:
    """The pre-tokens of a text without special strings."""
    if not UNSURE.search(text):
        return CUTS.findall(text)
    cut = tokenizer.pre_tokenizer.pre_tokenize_str(text)
    return [text[start:end] for _, (start, end) in cut]


def frequencies(text: str, tokenizer) -> tuple[Counter, int]:
    """Pre-token frequencies and the number of special strings."""
    parts = text.split(SPECIAL)
    counts = Counter(pretokens(parts[0], tokenizer))
    for part in parts[1:]:
        counts.update(pretokens(part, tokenizer))
    return counts, len(parts) - 1


def pieces(found: list[str], tokenizer) -> np.ndarray:
    out = np.empty(len(found), np.int64)
    for at in range(0, len(found), 10_000):
        encoded = tokenizer.encode_batch_fast(found[at : at + 10_000], add_special_tokens=False)
        out[at : at + len(encoded)] = [len(e) for e in encoded]
    return out


def head(placed: DataFrame, definition) -> dict[str, int]:
    """Pieces of the pre-tokens that occur in most of the chosen documents."""
    total = placed.count()
    share = min(1.0, HEAD_DOCS / max(total, 1))
    chosen = placed.filter(F.pmod(F.xxhash64(*ROW), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    def run(batches):
        tokenizer, counts = load(definition.value), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(frequencies(text, tokenizer)[0].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["pretoken", "n"],
        )

    counted = chosen.select(text_column().alias("text")).mapInArrow(run, "pretoken string, n long")
    counted = counted.groupBy("pretoken").agg(F.sum("n").alias("n")).filter("n > 1").persist()
    try:
        # At most one row per number of chosen documents.
        histogram = counted.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n"))
        least, room = None, HEAD
        for row in histogram.collect():
            room -= row["k"]
            if room < 0:
                break
            least = row["n"]
        if least is None:
            return {}
        found = [row[0] for row in counted.filter(F.col("n") >= least).select("pretoken").collect()]
    finally:
        counted.unpersist()
    return dict(zip(found, pieces(found, load(definition.value)).tolist()))


_FIRST = "doc_id long, _file long, _at long, n_bytes long, pieces long, pretoken string, n long"


def _first_pass(definition, known):
    """Per document one row with its head's sum, and one row per other pre-token."""

    def run(batches):
        tokenizer, table = load(definition.value), known.value
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                doc_ids, files, places, texts = (part.column(i).to_pylist() for i in range(4))
                row, sums, others, counts, lengths = [], [], [], [], []
                for text in texts:
                    found, special = frequencies(text, tokenizer)
                    total, rest = special, 0
                    for pretoken, n in found.items():
                        size = table.get(pretoken)
                        if size is None:
                            others.append(pretoken)
                            counts.append(n)
                            rest += 1
                        else:
                            total += n * size
                    sums.append(total)
                    row.append(rest)
                    lengths.append(len(text.encode()))
                row = np.array(row)
                k, m = len(texts), len(others)
                none, zeros = pa.nulls(m, pa.int64()), np.zeros(m, np.int64)

                def longs(values):
                    values = np.array(values, np.int64)
                    return pa.array(np.concatenate([values, np.repeat(values, row)]))

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(doc_ids, pa.int64()), none]),
                        longs(files),
                        longs(places),
                        pa.array(np.concatenate([np.array(lengths, np.int64), zeros])),
                        pa.array(np.concatenate([np.array(sums, np.int64), zeros])),
                        pa.array([None] * k + others, pa.string()),
                        pa.array(np.concatenate([np.zeros(k, np.int64), np.array(counts, np.int64)])),
                    ],
                    ["doc_id", *ROW, "n_bytes", "pieces", "pretoken", "n"],
                )

    return run


def _second_pass(definition):
    """Counts each pre-token of a sorted stream once; rows without one pass through."""

    def run(batches):
        tokenizer = load(definition.value)
        last: tuple[str | None, int] = (None, 0)
        for batch in batches:
            coded = batch.column("pretoken").dictionary_encode()
            found = coded.dictionary.to_pylist()
            new = [p for p in found if p != last[0]]
            sizes = dict(zip(new, pieces(new, tokenizer).tolist()))
            sizes.setdefault(last[0], last[1])
            each = np.array([sizes[p] for p in found] + [0], np.int64)
            at = coded.indices.fill_null(len(found)).to_numpy(zero_copy_only=False)
            if found:
                last = (found[-1], sizes[found[-1]])
            product = each[at] * batch.column("n").to_numpy() + batch.column("pieces").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *ROW, "n_bytes")] + [pa.array(product)],
                ["doc_id", *ROW, "n_bytes", "pieces"],
            )

    return run


def count_tokens(docs: DataFrame, definition: str) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``; ``definition`` is the tokenizer's JSON."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(definition)
    placed = located(docs)
    known = context.broadcast(head(placed, shared))
    rows = placed.select(F.col("doc_id").cast("long"), *ROW, text_column().alias("text"))
    rows = rows.mapInArrow(_first_pass(shared, known), _FIRST)
    alone = F.col("pretoken").isNull()
    dealt = rows.repartition(F.when(alone, F.xxhash64(*ROW)).otherwise(F.xxhash64("pretoken")))
    counted = dealt.sortWithinPartitions("pretoken").mapInArrow(
        _second_pass(shared), "doc_id long, _file long, _at long, n_bytes long, pieces long"
    )
    total = counted.groupBy(*ROW).agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum("pieces").alias("n_tokens"),
    )
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
