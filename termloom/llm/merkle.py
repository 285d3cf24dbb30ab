"""Merkle manifest of a dataset, with proofs expanded from octopus multiproofs.

Every row is a leaf. The leaves of a source, by id, are a tree of runs of ``ARITY``; the sources'
subroots are the leaves of one more tree, whose top is the root.

1. ``leaves`` hashes the rows where they are read; from then on only digests move. All leaves are
   numbered by range partitions, so a source with a third of all rows is many tasks.
2. ``partitions`` packs consecutive leaves of a source, a whole subtree of ``HEIGHT`` levels, and
   hashes it to its top. One row is one leaf partition.
3. ``grow`` packs and hashes the tops in the same way, ``HEIGHT`` levels a round, and keeps the nodes.
4. ``multiproofs`` gives each leaf partition the smallest set of node coordinates from which, with its
   own leaves, all its leaves' proofs follow (``frontier``): what lies inside is derived, so
   only siblings of what the partition derives are asked for. Each is fetched once per partition,
   by a join on its coordinates.
5. ``expand`` derives the shared interiors of a partition once and reads every leaf's proof off them.

Digests are SHA-256 of concatenated inputs, lowercase hex digits where a digest is an input, 32 bytes in tables.
Order: ids ascending, null first, equal ids by leaf. Nulls: a null field is ``-``, a null source is a
source of its own that comes first, and a row with a null id is never tampered with. Equal rows are
leaves of their own. Extra columns play no part. Without rows there is no root and no result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located
from termloom.plans.joins import attach, fits_broadcast
from termloom.plans.numbering import with_dense_ids
from termloom.plans.staging import stage

ARITY = 3
# Levels of a packed subtree of 2,187 leaves.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree of the subroots; a source's tree is ``-`` or ``=`` and its name, which sort null first.
TOP = ""
DIGEST = 32


def node_hash(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def parents(nodes: list[str]) -> list[str]:
    return [node_hash(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]


def height(size: int) -> int:
    """Levels above the leaves of a tree of ``size``."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def frontier(known: np.ndarray, size: int, level: int = 0) -> list[tuple[int, int]]:
    """The fewest nodes (level, index) that give the proofs of the ``known`` leaves along with those.

    ``known`` are ascending indexes on ``level`` of a tree that has ``size`` nodes there.
    """
    wanted = []
    while size > 1:
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        members = members[members < size]
        wanted += [(level, int(i)) for i in np.setdiff1d(members, known, assume_unique=True)]
        known, size, level = runs, -(-size // ARITY), level + 1
    return wanted


def siblings(
    first: int, nodes: list[str], size: int, fetched: dict[tuple[int, int], str]
) -> tuple[list[dict[int, tuple[str, str]]], str]:
    """Per level, what stands left and right of each node derived in its run; and the tree's top.

    ``nodes`` are consecutive leaves from index ``first``; ``fetched`` has their ``frontier``.
    """
    beside, known, level = [], dict(enumerate(nodes, first)), 0
    while size > 1:
        here, above = {}, {}
        for run in dict.fromkeys(i // ARITY for i in known):
            places = range(run * ARITY, min(size, (run + 1) * ARITY))
            digests = [known[i] if i in known else fetched[level, i] for i in places]
            for at, i in enumerate(places):
                if i in known:
                    here[i] = "".join(digests[:at]), "".join(digests[at + 1 :])
            above[run] = node_hash(digests)
        beside.append(here)
        known, size, level = above, -(-size // ARITY), level + 1
    return beside, next(iter(known.values()))


def path(index: int, beside: list[dict[int, tuple[str, str]]]) -> list[tuple[str, str]]:
    """A leaf's siblings (left, right), level by level."""
    steps = []
    for here in beside:
        steps.append(here[index])
        index //= ARITY
    return steps


def fold(digest: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _leaf(text: Column) -> Column:
    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def without_newlines() -> Column:
    """The tampered text where the rule tampers with it, else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return F.when(chosen & F.contains(F.col("text"), F.lit("\n")), changed)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``tree``, ``doc_id``, ``leaf`` and, where ``tampered`` gives a text, the leaf with that."""
    other = F.lit(None).cast("string") if tampered is None else tampered
    rows = located(docs.select(*FIELDS)).withColumn("_other", other)
    return stage(
        rows.select(
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            _leaf(F.col("text")).alias("leaf"),
            F.when(F.col("_other").isNotNull(), _leaf(F.col("_other"))).alias("tampered"),
            *ROW,
        ),
        "merkle-leaves",
    )


def _runs(batches, columns: int):
    """Tables of rows that agree in the first ``columns`` columns; one is held at a time."""
    held, key = [], None
    for batch in batches:
        count = len(batch)
        if not count:
            continue
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns))))
        starts = [0] + [i for i in range(1, count) if keys[i] != keys[i - 1]]
        for start, end in zip(starts, [*starts[1:], count]):
            if keys[start] != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = keys[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield key, pa.Table.from_batches(held)


def _hex(digests: list[bytes]) -> list[str]:
    return [d.hex() for d in digests]


def _split(joined: bytes) -> list[str]:
    digits = joined.hex()
    return [digits[i : i + 2 * DIGEST] for i in range(0, len(digits), 2 * DIGEST)]


_PARTITION = (
    "tree string, part long, size long, doc_ids array<long>, leaves binary, "
    "places array<int>, tampered binary, top binary"
)


def _packed(levels: int):
    def run(batches):
        for (tree, part, size), rows in _runs(batches, 3):
            digests = rows.column("leaf").to_pylist()
            nodes = _hex(digests)
            for _ in range(min(levels, height(size))):
                nodes = parents(nodes)
            tampered = rows.column("tampered").to_pylist()
            places = [i for i, other in enumerate(tampered) if other is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree], pa.string()),
                    pa.array([part], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([b"".join(digests)], pa.binary()),
                    pa.array([places], pa.list_(pa.int32())),
                    pa.array([b"".join(tampered[i] for i in places)], pa.binary()),
                    pa.array([bytes.fromhex(nodes[0])], pa.binary()),
                ],
                ["tree", "part", "size", "doc_ids", "leaves", "places", "tampered", "top"],
            )

    return run


def _dealt(rows: DataFrame, levels: int, *columns: str) -> DataFrame:
    """Rows by their partition, in order; a partition has consecutive rows of one ``tree``."""
    part = F.expr(f"index div {ARITY**levels}").alias("part")
    placed = rows.select("tree", part, "size", "index", *columns).repartition("tree", "part")
    return placed.sortWithinPartitions("tree", "part", "index")


def partitions(rows: DataFrame, levels: int = HEIGHT) -> DataFrame:
    """The leaf partitions of ``leaves``."""
    order = ["tree", F.col("doc_id").asc_nulls_first(), "leaf", *ROW]
    numbered = with_dense_ids(rows, order_by=[F.col(c) if isinstance(c, str) else c for c in order])
    trees = numbered.groupBy("tree").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size"))
    placed = attach(numbered, trees, "tree").withColumn("index", F.col("id") - F.col("first"))
    dealt = _dealt(placed, levels, "doc_id", "leaf", "tampered")
    return stage(dealt.mapInArrow(_packed(levels), _PARTITION), "merkle-partitions")


_NODE = "tree string, level int, index long, size long, digest binary"


def _climbed(bottom: int, levels: int):
    def run(batches):
        for (tree, part, size), rows in _runs(batches, 3):
            nodes, first, out = _hex(rows.column("digest").to_pylist()), part * ARITY**levels, []
            for level in range(bottom + 1, bottom + 1 + min(levels, height(size))):
                nodes, first, size = parents(nodes), first // ARITY, -(-size // ARITY)
                out += [(level, first + i, size, bytes.fromhex(d)) for i, d in enumerate(nodes)]
            heights, indexes, sizes, digests = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tree] * len(out), pa.string()),
                    pa.array(heights, pa.int32()),
                    pa.array(indexes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                ["tree", "level", "index", "size", "digest"],
            )

    return run


def grow(nodes: DataFrame, level: int, levels: int = HEIGHT) -> DataFrame:
    """All nodes from ``level`` up to the top of every tree; ``size`` counts the nodes on a level.

    ``nodes`` (tree, index, size, digest) are all those on ``level``.
    """
    columns = ["tree", F.lit(level).cast("int").alias("level"), "index", "size", "digest"]
    found = bottom = nodes.select(*columns)
    while True:
        unfinished = bottom.filter("size > 1")
        if unfinished.isEmpty():
            return found
        dealt = _dealt(unfinished, levels, "digest")
        up = stage(dealt.mapInArrow(_climbed(level, levels), _NODE), "merkle-nodes")
        found = found.unionByName(up)
        level += levels
        bottom = up.filter(F.col("level") == level)


_WANTED = "tree string, part long, node string, of_top boolean, level int, index long"


def _node_name(tree, level, index) -> Column:
    return F.concat_ws("/", level.cast("string"), index.cast("string"), tree)


def _frontiers(sources: int, levels: int):
    def run(batches):
        for batch in batches:
            out = []
            for tree, part, size, place in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = np.array([part])
                # A partition is one node on the level of the tops, or its whole tree.
                inside = frontier(own, -(-size // ARITY**levels), levels)
                above = frontier(np.array([place]), sources)
                out += [(tree, part, f"{n}/{i}/{tree}", False, n, i) for n, i in inside]
                out += [(tree, part, f"{n}/{i}/{TOP}", True, n, i) for n, i in above]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int32(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["tree", "part", "node", "of_top", "level", "index"],
            )

    return run


def multiproofs(
    parts: DataFrame, subroots: DataFrame, store: DataFrame, sources: int, levels: int = HEIGHT
) -> DataFrame:
    """``tree``, ``part`` and the ``fetched`` nodes of its frontier, for each partition that has one."""
    place = subroots.select("tree", F.col("index").alias("place"))
    known = attach(parts.select("tree", "part", "size"), place, "tree")
    wanted = known.select("tree", "part", "size", "place").mapInArrow(
        _frontiers(sources, levels), _WANTED
    )
    named = store.select(_node_name(F.col("tree"), F.col("level"), F.col("index")).alias("node"), "digest")
    # At most (ARITY - 1) nodes for each level of two trees.
    met = attach(stage(wanted, "merkle-wanted"), named, "node")
    fetched = F.collect_list(F.struct("of_top", "level", "index", "digest")).alias("fetched")
    return met.groupBy("tree", "part").agg(fetched)


def _expanded(sources: int, root: str, levels: int):
    def run(batches):
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        for batch in batches:
            for row in batch.to_pylist():
                nodes, first = _split(row["leaves"]), row["part"] * ARITY**levels
                fetched: tuple[dict, dict] = ({}, {})
                for n in row["fetched"] or ():
                    fetched[n["of_top"]][n["level"], n["index"]] = n["digest"].hex()
                beside, subroot = siblings(first, nodes, row["size"], fetched[False])
                upper, _ = siblings(row["place"], [subroot], sources, fetched[True])
                upper = path(row["place"], upper)
                changed = dict(zip(row["places"], _split(row["tampered"])))
                proofs, folded = [], []
                for i, leaf in enumerate(nodes):
                    steps = path(first + i, beside) + upper
                    proofs.append(node_hash([left + right for left, right in steps]))
                    folded.append(fold(changed.get(i, leaf), steps))
                count = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(nodes),
                        pa.array([subroot] * count),
                        pa.array([root] * count),
                        pa.array(proofs),
                        pa.array(folded),
                        pa.array([f == root for f in folded]),
                    ],
                    names,
                )

    return run


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: its leaf, proof, and whether the leaf folds to the root.

    ``tampered`` is a text put in place of a row's own before its leaf is folded; null leaves it.
    """
    parts = partitions(leaves(docs, tampered), levels)
    tops = parts.select(
        "tree",
        F.col("part").alias("index"),
        F.ceil(F.col("size") / ARITY**levels).alias("size"),
        F.col("top").alias("digest"),
    )
    inner = grow(tops, levels, levels)
    subroots = inner.filter("size = 1").select("tree", "digest")
    numbered = with_dense_ids(subroots, after=-1, order_by=[F.col("tree")], id_column="index")
    subroots = stage(numbered, "merkle-subroots")
    sources = subroots.count()
    top = subroots.select(
        F.lit(TOP).alias("tree"), "index", F.lit(sources).cast("long").alias("size"), "digest"
    )
    upper = grow(top, 0, levels)
    root = upper.filter("size = 1").select("digest").first()
    root = bytes(root["digest"]).hex() if root else ""
    store = inner.unionByName(upper).filter("size > 1")
    paths = stage(multiproofs(parts, subroots, store, sources, levels), "merkle-paths")
    if fits_broadcast(paths):
        paths = F.broadcast(paths)
    place = subroots.select("tree", F.col("index").alias("place"))
    whole = attach(parts.drop("top"), place, "tree").join(paths, ["tree", "part"], "left")
    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )
    return whole.mapInArrow(_expanded(sources, root, levels), schema)
