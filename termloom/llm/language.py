"""Language identification by multinomial naive Bayes over hashed character n-grams.

A text's letters are lowercased; every run of letters, with a space on either side, gives its n-grams
of ``ORDERS`` characters, hashed into ``BUCKETS`` buckets. Digits, punctuation and white space
only separate. ``train`` counts the buckets per language over *all* given documents: a task adds up
its documents and gives a row for each language and bucket it met, and Spark sums these. The model is
the logarithm of the smoothed shares, a matrix of ``BUCKETS`` rows and at most ``LANGUAGES``
columns, which bounds what is broadcast (32 MiB); with more languages the most frequent are learnt.

``predict`` is one pass in Arrow batches: the n-grams of many texts are hashed at once, their rows
of the matrix gathered and summed per text. The score is the probability of the chosen language.

Nulls: a null text or one without letters is ``und`` with score 0, as is every text where no language
was learnt. Documents with a null language teach nothing. Of languages that fit alike the one
with the smallest name is chosen. Repeated rows and null ids are treated like others, extra columns
play no part. Texts are read whole; one of over a million characters is cut at white space, between
n-grams (a run of that length without white space is cut where it reaches it).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import sub_batches, text_column

ORDERS = (2, 3, 4)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LANGUAGES = 128
UNKNOWN = "und"
# Added to every count.
SMOOTHING = 0.5
# Cells of the matrix gathered at once.
CELLS = 1 << 22

_SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(rows: list[int], parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: the buckets of all n-grams, and the rows they come from, ascending."""
    lowered = [f" {part.lower()} " for part in parts]
    joined = "".join(lowered).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32)
    letter = _letters()[codes]
    near = letter.copy()
    near[1:] |= letter[:-1]
    near[:-1] |= letter[1:]
    row = np.repeat(np.array(rows), [len(part) for part in lowered])[near]
    space = ~letter[near]
    codes = np.where(space, _SPACE, codes[near]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    # Whether a space follows a space, or stands inside; it may only be first or last.
    rolled, broken = codes, space & np.roll(space, -1)
    for order in range(2, max(ORDERS) + 1):
        if len(codes) < order:
            return
        rolled = rolled[:-1] * np.uint64(0xD6E8FEB86659FD93) + codes[order - 1 :]
        ends = space[order - 1 :]
        whole = ~broken[: len(ends)]
        if order in ORDERS:
            found = rolled[whole]
            found = (found ^ (found >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(order)
            yield (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), row[: len(ends)][whole]
        broken = broken[: len(ends)] | ends


@dataclass
class Model:
    languages: list[str]  # ascending
    logs: np.ndarray  # a row for each bucket, a column for each language
    prior: np.ndarray

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its probability."""
        sums, met = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        step = max(1, CELLS // len(self.languages))
        for rows, parts in sub_batches(texts):
            for buckets, of in ngrams(rows, parts):
                met[of] = True
                for at in range(0, len(buckets), step):
                    part = of[at : at + step]
                    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                    gathered = self.logs[buckets[at : at + step]]
                    sums[part[first]] += np.add.reduceat(gathered, first, axis=0, dtype=np.float64)
        sums += self.prior
        best = sums.argmax(axis=1)
        shares = np.exp(sums - sums.max(axis=1, keepdims=True))
        score = np.where(met, 1 / shares.sum(axis=1), 0.0)
        return [self.languages[i] if m else UNKNOWN for i, m in zip(best, met)], score


def _counted(languages: list[str]):
    def run(batches):
        number = {language: i for i, language in enumerate(languages)}
        counts = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            of = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for rows, parts in sub_batches(texts):
                for buckets, row in ngrams(rows, parts):
                    counts += np.bincount(of[row] * BUCKETS + buckets, minlength=len(counts))
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])

    return run


def train(docs: DataFrame) -> Model:
    """Learns from all rows of ``docs`` (text, lang) with a language."""
    rows = docs.select(text_column().alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("lang is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    kept = sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    shares = {row["lang"]: row["n"] for row in kept}
    languages = sorted(shares)
    if not languages:
        return Model([], np.empty((BUCKETS, 0), np.float32), np.empty(0))
    rows = rows.filter(F.col("lang").isin(languages))
    counted = rows.mapInArrow(_counted(languages), "cell long, n long")
    # At most BUCKETS rows for each of the languages.
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(len(languages) * BUCKETS, SMOOTHING)
    counts[table.column("cell").to_numpy()] += table.column("n").to_numpy()
    counts = counts.reshape(len(languages), BUCKETS).T
    prior = np.array([shares[language] for language in languages], float)
    logs = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    return Model(languages, np.ascontiguousarray(logs), np.log(prior / prior.sum()))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found, scores = shared.value.classify(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
