"""Near-duplicate groups by improved consistent weighted sampling over TF-IDF shingles.

1. ``inverse_frequencies`` counts in how many documents every shingle of five words occurs, in a
   sketch of ``SKETCH`` counters indexed by the shingle's hash. Its size is fixed, so it can be
   broadcast whatever the corpus; the counters hold all documents. As a share of the corpus the
   count of an unrelated shingle in the same counter is constant, so weights mean the same at
   every size. Weight = (1 + ln tf) * (1 + ln(N / df) / ln N).
2. ``signatures`` draws ``BANDS * BAND_ROWS`` samples per document, each of which two documents
   share with the probability of their weighted Jaccard similarity s, and hashes them by bands:
   a pair shares a band with probability 1 - (1 - s^3)^12, that is 0.9998 at s = 0.8.
3. Documents with the same words are one node from here on. Nodes that share a band are
   candidates; connected candidates are a cluster. A cluster of at most ``GROUP_NODES``
   nodes and ``GROUP_SHINGLES`` shingles is verified in one task: pairs that share a band are
   compared by exact weighted Jaccard similarity, most shared bands first, unless they are
   connected already.
4. A larger cluster is verified by its bands instead: every band value is a group. The nodes of a
   band value too large are dealt over slots, and every pair of slots is a group, so all its
   nodes meet. Groups then meet in their common nodes. No candidate is left out; the price is
   that the work on such a band value grows with the square of its nodes.

Groups are classes of the verified links, over all documents. All steps write their small tables
to the shared folder. Whole texts move only for clusters' nodes.

Nulls and repeats: a null text is empty; documents without words form one class, documents of
fewer than five words have one shingle of all their words, rows with equal words are one class
whatever their ids, and a null id ranks last. Each row of the input gives one row. The row that stays
is the one with the smallest id, then the smallest place. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import (
    ROW,
    give_back,
    giving_back,
    kept,
    located,
    mix,
    text_column,
    without,
    word_hashes,
)
from termloom.llm.components import components
from termloom.plans.joins import fits_broadcast
from termloom.plans.numbering import with_dense_ids
from termloom.plans.staging import small_batches, stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
BAND_ROWS = 3
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 20
SKETCH = 1 << SKETCH_BITS
SKETCH_BLOCK = 4096
# Sketch blocks merged by one task at a time.
MERGE = 64
# Rows of the table of random draws; a shingle's hash picks its row.
DRAWS = 1 << 16
GROUP_NODES = 1000
GROUP_SHINGLES = 8_000_000
# Documents whose words are hashed at once.
DOCS_AT_ONCE = 256
# Shingles sampled at once, which bounds memory on very long texts.
CHUNK = 1 << 14

_LAST = (1 << 63) - 1


def hashed_texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text of a column."""
    for at in range(0, len(column), DOCS_AT_ONCE):
        yield from word_hashes(column.slice(at, DOCS_AT_ONCE).to_pylist())


def shingles(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each occurs."""
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(hashes) < SHINGLE:
        hashes = np.concatenate([hashes, np.zeros(SHINGLE - len(hashes), np.uint64)])
    last = len(hashes) - SHINGLE + 1
    rolled = np.zeros(last, np.uint64)
    for j in range(SHINGLE):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + last]
    return np.unique(mix(rolled), return_counts=True)


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch_batches(batches):
    counts, count, waiting, held = np.zeros(SKETCH, np.int64), 0, [], 0

    def settle():
        nonlocal counts, waiting, held
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=SKETCH)
        waiting, held = [], 0

    for batch in batches:
        for hashes in hashed_texts(batch.column(0)):
            count += 1
            waiting.append(_cells(shingles(hashes)[0]))
            held += len(waiting[-1])
            if held > SKETCH:
                settle()
    settle()
    if count:
        blocks = counts.reshape(-1, SKETCH_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(np.arange(len(blocks)), -1).astype(np.int32)),
                pa.array([_packed(b) for b in blocks] + [_packed(np.array([count]))]),
            ],
            ["block", "counts"],
        )


def _packed(counts: np.ndarray) -> bytes:
    width = np.min_scalar_type(int(counts.max()))
    return bytes([width.itemsize]) + counts.astype(width).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def _merge_blocks(key, rows: pa.Table) -> pa.Table:
    total = sum(_unpacked(data) for data in rows.column("counts").to_pylist())
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": [_packed(total)]})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The factor 1 + ln(N / df) / ln N of each counter of the sketch."""
    parts = docs.select(text_column().alias("text")).mapInArrow(
        giving_back(_sketch_batches), "block int, counts binary"
    )
    tasks = docs.rdd.getNumPartitions()
    while tasks > 1:
        # Each group holds about MERGE blocks of bounded size, whatever the number of tasks.
        tasks = -(-tasks // MERGE)
        share = F.pmod(F.xxhash64("counts"), F.lit(tasks)).alias("share")
        parts = parts.groupBy("block", share).applyInArrow(
            lambda key, rows: _merge_blocks(key, rows), "block int, counts binary"
        )
    # SKETCH / SKETCH_BLOCK rows and the number of documents.
    with small_batches(docs.sparkSession):
        blocks = {row["block"]: _unpacked(row["counts"]) for row in parts.collect()}
    if not blocks:
        return np.ones(SKETCH, np.float32)
    count = int(blocks.pop(-1)[0])
    factors = np.concatenate([blocks.pop(i) for i in range(len(blocks))], dtype=float)
    np.clip(factors, 1, max(count, 1), out=factors)
    np.divide(max(count, 1), factors, out=factors)
    np.log(factors, out=factors)
    factors /= np.log(max(count, 2))
    factors += 1
    return factors.astype(np.float32)


def sampler() -> Sampler:
    """One table of draws per worker."""
    return kept("near-dedup", "sampler", Sampler)


class Sampler:
    """Improved consistent weighted sampling with draws fixed by the seed."""

    def __init__(self, seed: int = 20100, samples: int = SAMPLES):
        rng = np.random.default_rng(seed)
        shape = (DRAWS, samples)
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        self.inverse = 1 / self.r
        self.beta = rng.random(shape, np.float32)
        log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.start = log_c + self.r * (self.beta - 1)
        self.samples = samples

    def draw(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per sample; ``hashes`` ascend and are not empty."""
        least = np.full(self.samples, np.inf, np.float32)
        chosen = np.zeros(self.samples, np.uint64)
        every = np.arange(self.samples)
        log_weights = np.log(weights).astype(np.float32)
        for at in range(0, len(hashes), CHUNK):
            part = hashes[at : at + CHUNK]
            row = (part & np.uint64(DRAWS - 1)).astype(np.int64)
            level = np.floor(log_weights[at : at + CHUNK, None] * self.inverse[row] + self.beta[row])
            rank = self.start[row] - self.r[row] * level
            best = rank.argmin(axis=0)
            lowest = rank[best, every]
            value = mix(part[best] ^ mix(level[best, every].astype(np.int64).view(np.uint64)))
            better = lowest < least
            least = np.where(better, lowest, least)
            chosen = np.where(better, value, chosen)
        return chosen


def band_keys(samples: np.ndarray) -> np.ndarray:
    rolled = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(BAND_ROWS):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + samples[j::BAND_ROWS])
    return rolled.view(np.int64)


def _weights(hashes, counts, factors) -> np.ndarray:
    return ((1 + np.log(counts)) * factors[_cells(hashes)]).astype(np.float32)


def signatures(placed: DataFrame, factors) -> DataFrame:
    """``doc_id``, place, digest of the words, number of shingles and band keys of every row.

    ``factors`` is a broadcast variable. A document without words has no keys.
    """

    def run(batches):
        draws = sampler()
        for batch in batches:
            digests, sizes, keys = [], [], []
            for hashes in hashed_texts(batch.column(3)):
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                found, counts = shingles(hashes)
                sizes.append(len(found))
                if len(found):
                    weights = _weights(found, counts, factors.value)
                    keys.append(band_keys(draws.draw(found, weights)))
                else:
                    keys.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", *ROW, "digest", "size", "keys"],
            )

    rows = placed.select(F.col("doc_id").cast("long"), *ROW, text_column().alias("text"))
    schema = f"doc_id long, {ROW[0]} long, {ROW[1]} long, digest binary, size long, keys array<long>"
    return rows.mapInArrow(giving_back(run, "near-dedup"), schema)


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key occurs more than once, with the key's number of rows and of shingles."""
    sizes = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"), F.min("node").alias("first")
    )
    return rows.join(sizes.filter("n > 1"), key)


def _fits():
    return (F.col("n") <= GROUP_NODES) & (F.col("weight") <= GROUP_SHINGLES)


def groups_of(nodes: DataFrame) -> DataFrame:
    """``node``, ``kind``, ``id`` and ``slot``: the groups in which each node is verified."""
    keyed = nodes.select("node", "size", F.explode("keys").alias("key"))
    shared = stage(_counted(keyed, "key"), "near-dedup-bands")
    edges = shared.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    clusters = components(edges)
    roots = clusters.select(F.col("root").alias("node"), "root").distinct()
    member = clusters.unionByName(roots).join(nodes.select("node", "size"), "node")
    sized = stage(_counted(member, "root"), "near-dedup-clusters")
    none = F.lit(0).cast("long").alias("slot")
    small = sized.filter(_fits()).select("node", F.lit(0).alias("kind"), F.col("root").alias("id"), none)
    large = sized.filter(~_fits()).select("node")
    if large.isEmpty():
        return small
    bands = shared.join(large, "node", "left_semi")
    by_band = bands.filter(_fits()).select("node", F.lit(1).alias("kind"), F.col("key").alias("id"), none)
    hot = bands.filter(~_fits())
    # Any two nodes of a hot band value meet in the group of their slots' pair.
    slots = F.greatest(
        F.ceil(2 * F.col("n") / GROUP_NODES), F.ceil(2 * F.col("weight") / GROUP_SHINGLES)
    ).cast("int")
    own = F.pmod(F.xxhash64("node", "key"), slots).cast("int")
    dealt = hot.select("node", "key", own.alias("own"), slots.alias("slots"))
    pair = F.expr(
        "transform(sequence(0, slots - 1), "
        "x -> cast(least(own, x) as bigint) * slots + greatest(own, x))"
    )
    in_slots = dealt.select(
        "node", F.lit(3).alias("kind"), F.col("key").alias("id"), F.explode(pair).alias("slot")
    )
    return small.unionByName(by_band).unionByName(in_slots)


def similarity(a, b) -> float:
    """Weighted Jaccard of two (hashes, weights, total), by the shorter one's look-ups."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(b[0]):
        return 1.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    common = float(np.minimum(a[1][same], b[1][at[same]]).sum())
    return common / max(a[2] + b[2] - common, 1e-12)


def linked(keys: np.ndarray, vectors: list) -> np.ndarray:
    """The first member of each member's class, by verified links between candidates."""
    parent = list(range(len(vectors)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(1, len(vectors)):
        shared = (keys[:i] == keys[i]).sum(axis=1)
        candidates = np.flatnonzero(shared)
        for j in candidates[np.argsort(-shared[candidates], kind="stable")]:
            x, y = find(i), find(int(j))
            if x == y:
                continue
            low, high = sorted((vectors[i][2], vectors[j][2]))
            if low >= SIMILARITY * high and similarity(vectors[i], vectors[j]) >= SIMILARITY:
                parent[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(len(vectors))])


def _vector_batches(factors):
    def run(batches):
        for batch in batches:
            hashes, weights = [], []
            for words in hashed_texts(batch.column(2)):
                found, counts = shingles(words)
                short, at = np.unique(found.astype(np.uint32), return_index=True)
                hashes.append(short.tobytes())
                weights.append(_weights(found, counts, factors.value)[at].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(hashes), pa.array(weights)],
                ["node", "keys", "groups", "hashes", "weights"],
            )

    return run


def _runs(batches) -> Iterator[list]:
    """Rows of equal ``kind, id, slot`` in a sorted stream; one run is held at a time."""
    held, mark = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["kind"], row["id"], row["slot"])
            if key != mark and held:
                yield held
                held = []
            mark = key
            held.append(row)
    if held:
        yield held


def _verify(batches):
    nodes, roots, whole = [], [], []
    for run in _runs(batches):
        run.sort(key=lambda row: row["node"])
        vectors = []
        for row in run:
            weights = np.frombuffer(row["weights"], np.float16).astype(np.float32)
            vectors.append((np.frombuffer(row["hashes"], np.uint32), weights, float(weights.sum())))
        first = linked(np.array([row["keys"] for row in run]), vectors)
        for i in np.flatnonzero(first != np.arange(len(run))):
            nodes.append(run[i]["node"])
            roots.append(run[first[i]]["node"])
            whole.append(run[i]["kind"] == 0)
    columns = [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64()), pa.array(whole, pa.bool_())]
    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "whole"])


def links(placed: DataFrame, nodes: DataFrame, factors) -> DataFrame:
    """Verified links ``a``, ``b`` that connect the members of every class of nodes.

    ``whole`` says that they come from a cluster verified in one task; ``b`` is then the root.
    """
    groups = groups_of(nodes)
    wanted = groups.groupBy("node").agg(F.collect_list(F.struct("kind", "id", "slot")).alias("groups"))
    wanted = stage(wanted.join(nodes.select("node", "keys", *ROW), "node"), "near-dedup-groups")
    sent = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    texts = placed.select(*ROW, text_column().alias("text")).join(sent, list(ROW))
    vectors = texts.select("node", "keys", "text", "groups").mapInArrow(
        giving_back(_vector_batches(factors)),
        "node long, keys array<long>, groups array<struct<kind: int, id: long, slot: long>>, "
        "hashes binary, weights binary",
    )
    rows = vectors.select("node", "keys", "hashes", "weights", F.inline("groups"))
    dealt = rows.repartition("kind", "id", "slot").sortWithinPartitions("kind", "id", "slot")
    with small_batches(placed.sparkSession):
        return stage(dealt.mapInArrow(_verify, "a long, b long, whole boolean"), "near-dedup-links")


def classify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, place, ``class_id``, ``class_size``, ``keep``.

    ``class_id`` is the smallest id of the class; ``keep`` says whether the row stays.
    """
    return _classify(located(docs))


def _classify(placed: DataFrame) -> DataFrame:
    factors = placed.sparkSession.sparkContext.broadcast(inverse_frequencies(placed))
    give_back()
    with small_batches(placed.sparkSession):
        signed = stage(signatures(placed, factors), "near-dedup-signatures")
    rank = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "doc_id", *ROW)
    distinct = signed.groupBy("digest").agg(
        F.min(rank).alias("first"),
        F.first("keys").alias("keys"),
        F.first("size").alias("size"),
        F.count(F.lit(1)).alias("copies"),
    )
    nodes = stage(with_dense_ids(distinct, id_column="node"), "near-dedup-nodes")
    flat = nodes.select("node", "keys", "size", *(F.col(f"first.{c}").alias(c) for c in ROW))
    found = links(placed, flat, factors)
    # Signatures and links are written.
    factors.destroy()
    # A cluster verified in one task is final; groups of a larger one meet in their nodes.
    final = found.filter("whole").select(F.col("a").alias("node"), F.col("b").alias("root"))
    partial = found.filter("not whole")
    classes = final if partial.isEmpty() else final.unionByName(components(partial))
    roots = classes.select(F.col("root").alias("node"), "root").distinct()
    rooted = nodes.join(classes.unionByName(roots), "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    sizes = rooted.groupBy("root").agg(
        F.min("first").alias("kept"), F.sum("copies").alias("class_size")
    )
    shared = rooted.join(sizes.filter("class_size > 1"), "root").select("digest", "kept", "class_size")
    shared = stage(shared, "near-dedup-classes")
    if fits_broadcast(shared):
        shared = F.broadcast(shared)
    joined = signed.join(shared, "digest", "left")
    return joined.select(
        "doc_id",
        *ROW,
        F.when(F.col("kept").isNull(), F.col("doc_id")).otherwise(F.col("kept.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.coalesce(
            (F.col("kept._file") == F.col("_file")) & (F.col("kept._at") == F.col("_at")), F.lit(True)
        ).alias("keep"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs``, all columns unchanged, with one row of each class."""
    placed = located(docs)
    return without(placed, _classify(placed).filter(~F.col("keep")))
