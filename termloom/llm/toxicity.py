"""Toxicity by the nearest labelled examples.

``train`` takes a bounded sample of labelled documents (at most ``TOXIC_EXAMPLES`` and
``CLEAN_EXAMPLES``, chosen by a hash of the id), counts in how many of *all* documents every word
occurs, and indexes the examples' TF-IDF vectors over all of their words. Words are 64-bit hashes.
The index is an inverted one whose example ids are cut into blocks of ``BLOCK``; for each word and
block it keeps the largest weight. The words that most examples hold are a dense matrix instead,
multiplied for many queries at once. A query bounds every block's cosine by the block's largest
dense part plus those maxima, scores the most promising blocks, and then only those whose bound
reaches the k-th best cosine found. Blocks left out cannot hold a nearer example, so the nearest
``NEIGHBOURS`` are exact. A query whose dense part singles out no block would be left with nearly
all of them, and is scored on its whole posting lists, without bounds.

A document's vector has all of its words, weighted by TF-IDF. No word is left out; one that tells the
labels apart, by a chi-square over ``LIKELY_CHI2`` among the examples, weighs more by the root of
their ratio, or else ordinary words would outvote the few that matter. Words that no example holds change only its length:
those in more than one of ``COMMON`` documents are sent along with the index, the others are joined
with the document frequencies and summed per row.

The nearest examples vote with their cosine as weight; the vote is shrunk to the labels' share
where they are far, and mapped to a probability by a logistic curve fitted on the examples'
leave-one-out votes. The search is one pass over the documents in Arrow batches; the index sent to
the tasks is bounded by the sample's words.

Nulls: a null text is empty. A document that shares no word with an example gets the share of
toxic labels among the examples without words. Labels with a null id or null ``toxic`` are ignored;
a document labelled twice counts as toxic if any label says so, and of several texts with a
labelled id one is the example. Without examples of both labels the score is the labels' share (0
if there are none). Repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import ROW, give_back, giving_back, located, text_column, without, word_hashes
from termloom.plans.staging import small_batches, stage

TOXIC_EXAMPLES = 4096
CLEAN_EXAMPLES = 8192
# Words in more than one of so many documents are sent to the tasks even if no example holds them.
COMMON = 1000
# Chi-square with one degree of freedom at p = 0.00001.
LIKELY_CHI2 = 19.5
BLOCK = 64
# Words held as a dense matrix at most, and queries multiplied with it at a time.
DENSE = 512
CHUNK = 64
NEIGHBOURS = 15
# Blocks scored before bounds are compared.
FIRST_BLOCKS = 4
# Blocks are bounded if the best dense part of one is so many times that of the middle one.
STANDS_OUT = 2.0
# More than the error of single precision in a cosine.
NEAR = 1e-5
THRESHOLD = 0.7
# Examples that one task compares with the others.
EXAMPLES_AT_ONCE = 2048
# Documents whose words a task takes up at a time, words it sorts at once, and sorted ones it holds
# before it hands them on.
DOCS_AT_ONCE = 256
WAITING = 1 << 18
HELD = 1 << 19
# Weight of the labels' share in a vote.
SHRINK = 0.5

EVIDENCE = T.ArrayType(
    T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("toxic", T.IntegerType()),
            T.StructField("cosine", T.DoubleType()),
        ]
    )
)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, …`` of every range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


class BlockMaxIndex:
    """Cosine search over unit vectors given as (example, term, weight) triples."""

    def __init__(self, examples: int, terms: int, rows, columns, weights):
        rows, columns = np.asarray(rows), np.asarray(columns, np.int32)
        weights = np.asarray(weights, np.float32)
        held = np.bincount(columns, minlength=terms)
        most = np.argsort(-held, kind="stable")[:DENSE]
        most = most[held[most] * BLOCK > examples]
        # A term's column in the dense matrix, or -1.
        self.slot = np.full(terms, -1, np.int32)
        self.slot[most] = np.arange(len(most))
        self.examples, self.blocks = examples, max(1, -(-examples // BLOCK))
        self.width = len(most)
        small = np.min_scalar_type(examples)
        slots = self.slot[columns]
        common = slots >= 0
        # What is sent: the dense terms' triples, and postings by term and example.
        self.common = rows[common].astype(small), slots[common].astype(np.int16), weights[common]
        rare = ~common
        del slots, common
        rows, columns, weights = rows[rare], columns[rare], weights[rare]
        order = np.lexsort((rows, columns))
        self.first = np.searchsorted(columns[order], np.arange(terms + 1)).astype(np.int32)
        self.rare = rows[order].astype(small), weights[order]
        self.dense = None

    def vectors(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and weights of the examples from ``start`` to ``end``, one after another, and where each
        begins."""
        self._ready()
        rows, slots = np.nonzero(self.dense[start:end])
        dense_terms = np.flatnonzero(self.slot >= 0)
        dense_terms = dense_terms[np.argsort(self.slot[dense_terms])]
        low, high = np.uint64(start << 32), np.uint64(end << 32)
        at = np.flatnonzero((self.postings >= low) & (self.postings < high))
        found = self.postings[at]
        terms = np.concatenate([dense_terms[slots], np.searchsorted(self.first, at, side="right") - 1])
        weights = np.concatenate(
            [self.dense[rows + start, slots], found.astype(np.uint32).view(np.float32)]
        )
        rows = np.concatenate([rows, (found >> np.uint64(32)).astype(np.int64) - start])
        order = np.lexsort((terms, rows))
        return terms[order], weights[order], np.searchsorted(rows[order], np.arange(end - start + 1))

    def _ready(self) -> None:
        """Builds what searches use from what was sent."""
        if self.dense is not None:
            return
        rows, weights = self.rare
        self.dense = np.zeros((self.blocks * BLOCK, self.width), np.float32)
        np.add.at(self.dense, self.common[:2], self.common[2])
        # An example in the upper half, its weight's bits in the lower.
        self.postings = rows.astype(np.uint64)
        self.postings <<= np.uint64(32)
        self.postings |= weights.view(np.uint32)
        block = (rows // BLOCK).astype(np.min_scalar_type(self.blocks))
        # Only the cells that have postings: their first posting, block and largest weight.
        begins = np.ones(len(rows), bool)
        begins[1:] = block[1:] != block[:-1]
        begins[self.first[:-1][self.first[:-1] < len(rows)]] = True
        starts = np.flatnonzero(begins).astype(np.int32)
        self.starts = np.append(starts, np.int32(len(rows)))
        self.block = block[starts]
        self.highest = np.maximum.reduceat(weights, starts) if len(starts) else weights
        self.first_cell = np.searchsorted(starts, self.first).astype(np.int32)
        self.common = self.rare = None

    def _dense_query(self, terms, weights) -> np.ndarray:
        query = np.zeros(self.width)
        slots = self.slot[terms]
        query[slots[slots >= 0]] = weights[slots >= 0]
        return query

    def dense_parts(self, queries) -> np.ndarray:
        """The part of each query's cosines that comes from the dense terms, within ``NEAR``."""
        self._ready()
        matrix = np.array([self._dense_query(*query) for query in queries], np.float32)
        return matrix @ self.dense.T

    def nearest(
        self, terms, weights, k: int, skip: int = -1, base: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the ``k`` largest positive cosines, ties by example; and the cosines.

        ``base`` is the query's row of ``dense_parts``.
        """
        if base is None:
            base = self.dense_parts([(terms, weights)])[0]
        query = self._dense_query(terms, weights)
        rare = self.slot[terms] < 0
        terms, weights = terms[rare], weights[rare]

        def summed(postings, held, factor):
            """The cosines so far, and those examples' parts from the given postings."""
            values = postings.astype(np.uint32).view(np.float32) * np.repeat(factor, held)
            of = (postings >> np.uint64(32)).view(np.int64)
            found = np.bincount(of, values, minlength=len(base)) + base
            if skip >= 0:
                found[skip] = 0
            return found

        highest = base.reshape(-1, BLOCK).max(axis=1)
        if highest.max() >= STANDS_OUT * np.median(highest):
            scores = self._in_best_blocks(terms, weights, highest, k, summed)
        else:
            # No example stands out, so bounds would leave nearly all blocks.
            bounds = zip(self.first[terms].tolist(), self.first[terms + 1].tolist())
            lists = [self.postings[start:end] for start, end in bounds]
            held = self.first[terms + 1] - self.first[terms]
            scores = summed(np.concatenate([self.postings[:0], *lists]), held, weights)
        # At least k examples reach the k-th largest of the blocks' best.
        enough = _least(scores.reshape(-1, BLOCK).max(axis=1), k) - NEAR
        found = np.flatnonzero((scores > 0) & (scores >= enough))
        found = found[scores[found] >= _least(scores[found], k) - NEAR]
        # The dense part anew, in double precision.
        scores = scores[found] - base[found] + self.dense[found].astype(float) @ query
        near = scores.round(6)
        order = np.argsort(-near, kind="stable")[:k]
        return found[order], np.minimum(near[order], 1.0)


    def _in_best_blocks(self, terms, weights, highest, k: int, summed) -> np.ndarray:
        """The cosines in all blocks that may hold one of the ``k`` nearest, 0 elsewhere.

        ``highest`` is the largest dense part of each block.
        """
        lengths = self.first_cell[terms + 1] - self.first_cell[terms]
        cells, each = _ranges(self.first_cell[terms], lengths), np.repeat(weights, lengths)
        block = self.block[cells]
        bound = highest + np.bincount(block, self.highest[cells] * each, minlength=self.blocks)

        def scored(wanted):
            chosen = wanted[block]
            at, factor = cells[chosen], each[chosen]
            held = self.starts[at + 1] - self.starts[at]
            scores = summed(self.postings[_ranges(self.starts[at], held)], held, factor)
            return scores * np.repeat(wanted, BLOCK)

        # The best blocks first; then all whose bound reaches the k-th cosine found there.
        wanted = np.zeros(self.blocks, bool)
        wanted[np.argpartition(-bound, min(FIRST_BLOCKS, self.blocks) - 1)[:FIRST_BLOCKS]] = True
        scores = scored(wanted)
        more = (bound >= _least(scores[np.repeat(wanted, BLOCK)], k) - NEAR) & (bound > 0)
        return scored(more | wanted) if (more & ~wanted).any() else scores


def _least(scores: np.ndarray, k: int) -> float:
    """The ``k``-th largest of the scores."""
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else 0.0


def _counted_words(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the hashes of its words, ascending, and how often each occurs."""
    return [np.unique(hashes.view(np.int64), return_counts=True) for hashes in word_hashes(texts)]


@dataclass
class Model:
    terms: np.ndarray  # ascending hashes
    idf: np.ndarray  # for words that tell labels apart, raised
    index: BlockMaxIndex | None
    ids: np.ndarray
    toxic: np.ndarray
    share: float
    empty: float
    # Number of documents, and the document frequencies of all words.
    count: int = 0
    frequencies: DataFrame | None = None
    slope: float = 1.0
    offset: float = 0.0
    # The model as sent to the tasks, still without slope and offset.
    shared: Broadcast | None = None

    def vector(self, hashes: np.ndarray, counts: np.ndarray):
        """Terms and unit weights of the given words, their length, and which words are given."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        given = self.terms[at] == hashes if len(self.terms) else np.zeros(len(hashes), bool)
        at = at[given]
        weights = (1 + np.log(counts[given])) * self.idf[at]
        length = np.sqrt((weights**2).sum())
        return at, weights / max(length, 1e-12), length, given

    def raw(self, near, cosines) -> float:
        return (cosines @ self.toxic[near] + SHRINK * self.share) / (cosines.sum() + SHRINK)

    def probability(self, raw) -> np.ndarray:
        raw = np.clip(raw, 1e-4, 1 - 1e-4)
        line = self.slope * np.log(raw / (1 - raw)) + self.offset
        return 1 / (1 + np.exp(-np.clip(line, -30, 30)))

    def search(self, texts: list[str]):
        """Per text: neighbours, cosines and length by the given words; the other words' hashes and
        weights without their idf."""
        for at in range(0, len(texts), CHUNK):
            counted = _counted_words(texts[at : at + CHUNK])
            vectors = [self.vector(*c) for c in counted]
            if self.index is not None:
                bases = self.index.dense_parts([v[:2] for v in vectors])
            for i, ((hashes, counts), (terms, weights, length, given)) in enumerate(zip(counted, vectors)):
                near = cosines = _NONE
                if self.index is not None and len(terms):
                    near, cosines = self.index.nearest(terms, weights, NEIGHBOURS, -1, bases[i])
                others = ~given if len(near) else np.zeros(len(given), bool)
                yield near, cosines, length, hashes[others], 1 + np.log(counts[others])


_NONE = np.empty(0, np.int64)


def _logistic(raw, labels, weights) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve through the logit of ``raw``."""
    raw = np.clip(raw, 1e-4, 1 - 1e-4)
    design = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        # A slight pull to the unchanged vote keeps the curve finite on separable labels.
        slope = design.T @ (weights * (p - labels)) + 0.01 * (theta - [1.0, 0.0])
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        theta = theta - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def _sample(labels: DataFrame, toxic: int, count: int, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids of one class, by hash; ``count`` is the class size."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = labels.filter(F.col("toxic") == toxic)
    # The cut by share leaves few more than the limit for the one task that sorts them.
    if count > limit:
        rows = rows.filter(place < int((1 << 30) * min(1.0, 1.3 * limit / count)))
    return rows.orderBy(place, "doc_id").limit(limit)


def _class_sizes(rows: DataFrame) -> dict[int, int]:
    counted = rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))
    return {row["toxic"]: row["n"] for row in counted.collect()}


def _example_terms(batches):
    for batch in batches:
        found = _counted_words(batch.column(2).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([hashes.tobytes() for hashes, _ in found], pa.binary()),
                pa.array([counts.astype(np.int32).tobytes() for _, counts in found], pa.binary()),
            ],
            ["doc_id", "toxic", "terms", "counts"],
        )


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms, ascending, and the sums of their numbers."""
    terms = np.concatenate([terms for terms, _ in parts])
    found, place = np.unique(terms, return_inverse=True)
    return found, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)


def _frequency_batches(batches):
    waiting, held, parts, count = [], 0, [], 0
    names = ["term", "n"]

    def settled():
        """What waits, each term with the number of its documents."""
        return np.unique(np.concatenate(waiting), return_counts=True)

    def summed():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _added(parts)], names)

    for batch in batches:
        for at in range(0, len(batch), DOCS_AT_ONCE):
            texts = batch.column(0).slice(at, DOCS_AT_ONCE).to_pylist()
            count += len(texts)
            waiting += [np.unique(hashes.view(np.int64)) for hashes in word_hashes(texts)]
            if sum(map(len, waiting)) > WAITING:
                parts.append(settled())
                held += len(parts[-1][0])
                waiting = []
            if held > HELD:
                parts = [_added(parts)]
                held = len(parts[0][0])
            if 2 * held > HELD and len(parts) == 1:
                yield summed()
                parts, held = [], 0
    if waiting:
        parts.append(settled())
    if parts:
        yield summed()
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([count])], names)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term``, ``n``: in how many of all documents each word occurs; null has their number."""
    texts = docs.select(text_column().alias("text"))
    parts = texts.mapInArrow(giving_back(_frequency_batches), "term long, n long")
    with small_batches(docs.sparkSession):
        return stage(parts.groupBy("term").agg(F.sum("n").alias("n")), "toxicity-frequencies")


def _sent(frequencies: DataFrame, examples: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of the examples or of more than one in ``COMMON`` documents, and their frequencies."""
    shared = frequencies.sparkSession.sparkContext.broadcast(examples)

    def run(batches):
        for batch in batches:
            terms = batch.column(0).to_numpy()
            at = np.minimum(np.searchsorted(shared.value, terms), len(shared.value) - 1)
            held = shared.value[at] == terms if len(shared.value) else np.zeros(len(terms), bool)
            yield batch.filter(pa.array(held | (batch.column(1).to_numpy() * COMMON > count)))

    kept = frequencies.filter("term is not null").mapInArrow(giving_back(run), "term long, n long")
    # Bounded by the sample's words and COMMON times the mean number of words of a document.
    table = kept.toArrow()
    shared.destroy()
    terms, n = (table.column(i).to_numpy() for i in range(2))
    order = np.argsort(terms)
    return terms[order], n[order]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels`` (doc_id, toxic) are those that may be learnt from."""
    labels = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    sizes = _class_sizes(labels)
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    none = Model(_NONE, np.empty(0), None, _NONE, _NONE, share, share)
    if len(sizes) < 2:
        return none
    sample = _sample(labels, 1, sizes[1], TOXIC_EXAMPLES).unionByName(
        _sample(labels, 0, sizes[0], CLEAN_EXAMPLES)
    )
    examples = docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    rows = examples.select("doc_id", "toxic", "text").mapInArrow(
        giving_back(_example_terms), "doc_id long, toxic int, terms binary, counts binary"
    )
    one = F.min(F.struct("toxic", "terms", "counts")).alias("one")
    # At most one row for each id of the sample.
    known = rows.groupBy("doc_id").agg(one).select("doc_id", "one.*").orderBy("doc_id").toArrow()
    toxic = known.column("toxic").to_numpy().astype(np.int64)
    if not toxic.any() or toxic.all():
        return none
    ids = known.column("doc_id").to_numpy()
    hashes, ends = _flat(known.column("terms"), np.int64)
    counts, _ = _flat(known.column("counts"), np.int32)
    del known
    frequencies = document_frequencies(docs)
    count = frequencies.filter("term is null").first()["n"]
    terms, df = _sent(frequencies, np.unique(hashes), count)
    # Every word of an example is among the terms.
    columns = np.searchsorted(terms, hashes).astype(np.int32)
    del hashes
    lengths = np.diff(ends, prepend=0)
    idf = _idf(df, count) * _telling(len(terms), toxic, columns, lengths)
    model = replace(none, terms=terms, idf=idf, count=count, frequencies=frequencies)
    parts = [columns, counts]
    del columns, counts
    give_back()
    model = _fit(model, ids, toxic, parts, lengths, sizes)
    give_back()
    return model


def _flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in the rows of a binary column, and where each row's end."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts), np.cumsum([len(x) for x in parts])


def _idf(df, count):
    return np.log((1 + count) / (1 + df)) + 1


def _telling(size: int, toxic, columns, lengths) -> np.ndarray:
    """The factor, at least 1, by which each term's weight is raised."""
    is_toxic = np.repeat(toxic > 0, lengths)
    a, b = (np.bincount(columns[is_toxic == label], minlength=size).astype(float) for label in (True, False))
    n1, n0 = float(toxic.sum()), float((1 - toxic).sum())
    seen = a + b
    chance = n1 * n0 * seen * (n1 + n0 - seen)
    chi2 = (a * n0 - b * n1) ** 2 * (n0 + n1) / np.maximum(chance, 1)
    return np.sqrt(np.maximum(1, chi2 / LIKELY_CHI2))


def _shared(model: Model) -> Broadcast:
    session = SparkSession.getActiveSession()
    return session.sparkContext.broadcast(replace(model, frequencies=None))


def _example_votes(model: Model, examples: int) -> DataFrame:
    """The raw vote that each example gets from the others."""
    shared = model.shared

    def run(batches):
        model = shared.value
        index = model.index
        for batch in batches:
            # The ids of a batch follow one another.
            wanted = batch.column(0).to_pylist()
            for at in range(0, len(wanted), CHUNK):
                part = wanted[at : at + CHUNK]
                terms, weights, starts = index.vectors(part[0], part[-1] + 1)
                own = [slice(start, end) for start, end in zip(starts[:-1], starts[1:])]
                vectors = [(terms[o], weights[o]) for o in own]
                found, votes = [], []
                for e, vector, base in zip(part, vectors, index.dense_parts(vectors)):
                    near, cosines = index.nearest(*vector, NEIGHBOURS, e, base)
                    if len(near):
                        found.append(e)
                        votes.append(model.raw(near, cosines))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array(votes, pa.float64())], ["example", "vote"]
                )

    tasks = -(-examples // EXAMPLES_AT_ONCE)
    ids = SparkSession.getActiveSession().range(0, examples, 1, tasks)
    return ids.mapInArrow(giving_back(run), "example long, vote double")


def _fit(model: Model, ids, toxic, parts: list, lengths, sizes) -> Model:
    """``parts`` has the terms and counts of all examples and is emptied; ``lengths`` says how many
    each has."""
    columns, counts = parts
    parts.clear()
    weight = {k: sizes.get(k, 0) / max(1, int((toxic == k).sum())) for k in (0, 1)}
    silent = toxic[lengths == 0]
    toxic_silent = weight[1] * float((silent == 1).sum())
    clean_silent = weight[0] * float((silent == 0).sum())
    model.empty = (toxic_silent + model.share) / (toxic_silent + clean_silent + 1)
    with_terms = np.flatnonzero(lengths)
    if not len(with_terms):
        return model
    weights = counts.astype(np.float32)
    np.log(weights, out=weights)
    weights += 1
    weights *= model.idf.astype(np.float32)[columns]
    del counts
    starts = np.cumsum(lengths) - lengths
    held = np.bincount(columns, minlength=len(model.terms))
    # Examples that share their heaviest repeated term come next to each other, which tightens
    # blocks.
    heaviest = []
    for e in with_terms:
        own = slice(starts[e], starts[e] + lengths[e])
        heaviest.append(int(columns[own][np.argmax(np.where(held[columns[own]] > 1, weights[own], 0))]))
        weights[own] /= np.sqrt((weights[own].astype(float) ** 2).sum())
    order = with_terms[np.lexsort((ids[with_terms], heaviest))]
    at = _ranges(starts[order], lengths[order])
    columns, weights = columns[at], weights[at]
    del at
    lengths = lengths[order]
    rows = np.repeat(np.arange(len(order), dtype=np.min_scalar_type(len(order))), lengths)
    model.index = BlockMaxIndex(len(order), len(model.terms), rows, columns, weights)
    del rows, columns, weights
    model.ids, model.toxic = ids[order], toxic[order].astype(float)
    model.shared = _shared(model)
    # From here on only the tasks need it.
    model.index = None
    give_back()
    votes = np.full(len(order), model.share)
    found = _example_votes(model, len(order)).toArrow()
    votes[found.column("example").to_numpy()] = found.column("vote").to_numpy()
    model.slope, model.offset = _logistic(
        votes, model.toxic, np.where(model.toxic > 0, weight[1], weight[0])
    )
    return model


_FOUND = (
    f"doc_id long, {ROW[0]} long, {ROW[1]} long, near array<int>, cosines array<double>, "
    "length double, others array<long>, other_weights array<double>"
)


def _lists(arrays, kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([_NONE, *arrays]), kind))


def _votes(placed: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, place, ``score`` and ``evidence`` of every row."""
    shared = model.shared or _shared(model)
    # What a vote needs of the model.
    voter = replace(model, terms=_NONE, idf=_NONE, index=None, frequencies=None, shared=None)

    def parts(batches):
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                yield batch.slice(at, DOCS_AT_ONCE)

    def search(batches):
        model = shared.value
        for batch in parts(batches):
            near, cosines, lengths, others, weights = zip(*model.search(batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    _lists([n.astype(np.int32) for n in near], pa.int32()),
                    _lists(cosines, pa.float64()),
                    pa.array(lengths, pa.float64()),
                    _lists(others, pa.int64()),
                    _lists(weights, pa.float64()),
                ],
                ["doc_id", *ROW, "near", "cosines", "length", "others", "other_weights"],
            )

    rows = placed.select(F.col("doc_id").cast("long"), *ROW, text_column().alias("text"))
    found = rows.mapInArrow(giving_back(search), _FOUND)
    if model.frequencies is None:
        found = found.withColumn("rest", F.lit(0.0))
    else:
        with small_batches(placed.sparkSession):
            found = stage(found, "toxicity-found")
        # From here on no task needs the index; a further search gets it again.
        shared.unpersist()
        other = F.inline(F.arrays_zip(F.col("others").alias("term"), F.col("other_weights").alias("weight")))
        # None of these words is in more than one of COMMON documents that the model has seen.
        met = found.select(*ROW, other).join(model.frequencies, "term", "left")
        idf = F.log((1 + F.lit(model.count)) / (1 + F.coalesce("n", F.lit(0)))) + 1
        rest = met.groupBy(*ROW).agg(F.sum(F.pow(F.col("weight") * idf, 2)).alias("rest"))
        found = found.join(rest, list(ROW), "left").withColumn("rest", F.coalesce("rest", F.lit(0.0)))

    def vote(batches):
        for batch in batches:
            near, cosines, scores = [], [], []
            for n, c, length, rest in zip(*(batch.column(i).to_pylist() for i in range(3, 7))):
                near.append(np.array(n, np.int64))
                scale = length / np.sqrt(length**2 + rest) if n else 1.0
                cosines.append((np.array(c, float) * scale).round(6))
                scores.append(float(voter.probability(voter.raw(near[-1], cosines[-1]))) if n else voter.empty)
            at = np.concatenate([_NONE, *near])
            evidence = pa.StructArray.from_arrays(
                [
                    pa.array(voter.ids[at], pa.int64()),
                    pa.array(voter.toxic[at].astype(np.int32)),
                    pa.array(np.concatenate([_NONE, *cosines]), pa.float64()),
                ],
                ["doc_id", "toxic", "cosine"],
            )
            ends = np.cumsum([0, *map(len, near)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends), evidence),
                ],
                ["doc_id", *ROW, "score", "evidence"],
            )

    schema = [T.StructField(c, T.LongType()) for c in ("doc_id", *ROW)]
    schema += [T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE)]
    columns = ("doc_id", *ROW, "near", "cosines", "length", "rest")
    return found.select(*columns).mapInArrow(giving_back(vote), T.StructType(schema))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``evidence`` of every row."""
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return _votes(located(docs), model).select("doc_id", "score", predicted, "evidence")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that score below the threshold."""
    placed = located(docs)
    return without(placed, _votes(placed, model).filter(F.col("score") >= THRESHOLD))
