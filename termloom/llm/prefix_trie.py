"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt as a head of another one and its own remaining turns. Texts stay where they
are: a turn has an element (three residues of its content's digest), and a run of turns the pair
of its length and of ``sum(element[k] * BASE^k)``, in each residue. Pairs compose,
``(m, u) * (n, v) = (m + n, u + BASE^m * v)``, so a rebuilt prefix is the stored prefix of the head
composed with the difference of two stored prefixes of the own turns: arithmetic on two rows.

1. ``read_turns`` sorts all turns by conversation and order over range partitions, so that one very
   long conversation lies in many tasks, and writes them with the running pair of each task.
   The tasks' last pairs, one row a task, are composed into what each task starts from.
2. ``rebuild`` gives a row for each conversation and depth: prefix, parent's prefix, last turn.
3. ``turns_differ`` compares turns with equal elements by role and text, through their rows of
   the written table; in every one of the ``groups`` of equal prefixes the last turns and the
   parents' prefixes must agree, which by induction over the depth makes the groups exact. If two
   differ the job starts anew with another seed.
4. ``nodes``: a group is named by its smallest member. The nodes a conversation names lie on
   one path, so the sum over a subtree is the sum of its members' path totals, less what the
   path's upper nodes hold. No step walks the trie.

Order: by turn, null first; equal turns by role, text and place. Nulls: a null role or text is empty;
rows with a null conv_id are of no conversation and are left out. Repeated rows are turns of their own.
Extra columns play no part. Without conversations there is no node.
"""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import ROW, located, running_before, text_column
from termloom.plans.joins import attach
from termloom.plans.staging import stage

# Primes below 2^31; products of two residues fit 64 bits.
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = range(len(PRIMES))
# The head has at most HEADS - 1 turns, taken from the first of every FAMILY conversations.
HEADS = 9
FAMILY = 5
# Conversations per piece of an end list, and depths per piece of a path.
PIECE = 4096
# Turns of one task.
AT_BITS = 33

_E, _F, _X, _P = ([f"{name}{i}" for i in LANES] for name in "efxp")
KEY = ["depth", *_F]


def bases(seed: int) -> list[int]:
    rng = random.Random(seed)
    return [rng.randrange(1 << 20, p - 1) for p in PRIMES]


def _powers(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each of ``exponents``, by squaring."""
    out, square = np.ones(len(exponents), np.int64), base
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        odd = (exponents >> bit) & 1 == 1
        out[odd] = out[odd] * square % prime
        square = square * square % prime
    return out


def elements(roles: list[str], texts: list[str], seed: int) -> np.ndarray:
    """A row of residues for each turn."""
    key = seed.to_bytes(8, "little")
    found = []
    for role, text in zip(roles, texts):
        role, text = role.encode(), text.encode()
        content = len(role).to_bytes(8, "little") + role + text
        found.append(hashlib.blake2b(content, digest_size=8 * len(PRIMES), key=key).digest())
    words = np.frombuffer(b"".join(found), np.uint64).reshape(-1, len(PRIMES))
    return (words % np.array(PRIMES, np.uint64)).astype(np.int64)


def _scan(seed: int):
    """Adds the running pair of the task's rows, which are sorted, to each."""

    def run(batches):
        base, task, at = bases(seed), TaskContext.get().partitionId(), 0
        last, length, sums = None, 0, np.zeros(len(PRIMES), np.int64)
        for batch in batches:
            count = len(batch)
            if not count:
                continue
            convs = batch.column(0).to_numpy()
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            own = elements(roles, texts, seed)
            begins = np.concatenate([[True], convs[1:] != convs[:-1]])
            first, group = np.flatnonzero(begins), np.cumsum(begins) - 1
            goes_on = convs[0] == last
            start = np.where(group == 0, length if goes_on else 0, 0)
            place = start + np.arange(count) - first[group]  # from 0
            with_it, without = [], []
            for i, prime in enumerate(PRIMES):
                terms = own[:, i] * _powers(base[i], prime, place) % prime
                total = np.cumsum(terms)
                before = total - terms
                carried = np.where(group == 0, sums[i] if goes_on else 0, 0)
                before = (before - before[first][group] + carried) % prime
                without.append(before)
                with_it.append((before + terms) % prime)
                sums[i] = with_it[-1][-1]
            last, length = convs[-1], int(place[-1]) + 1
            lanes = [own[:, i] for i in LANES] + with_it + without
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(np.full(count, task, np.int64)),
                    pa.array(np.arange(at, at + count)),
                    pa.array(place + 1),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    *(pa.array(lane) for lane in lanes),
                ],
                ["conv_id", "role", "text", "task", "at", "own", "n_bytes", *_E, *_F, *_X],
            )
            at += count

    return run


def _composed(first: Column, power: Column, second: Column, lane: int) -> Column:
    return (first + power * second) % F.lit(PRIMES[lane])


def _carries(turns: DataFrame, seed: int) -> DataFrame:
    """What each task of the scan starts from: ``task``, ``conv_id``, length and pair so far."""
    place = F.struct("at", "conv_id", "own", *_F)
    ends = turns.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(place).alias("last"))
    rows, base = [], bases(seed)
    conv, length, sums = None, 0, [0] * len(PRIMES)
    # One row for each task of the scan.
    for row in ends.orderBy("task").collect():
        powers = [pow(b, length, p) for b, p in zip(base, PRIMES)]
        rows.append((row["task"], conv, length, *sums, *powers))
        end = row["last"]
        values = [end[f] for f in _F]
        if row["first"] == end["conv_id"] == conv:
            sums = [(s + w * v) % p for s, w, v, p in zip(sums, powers, values, PRIMES)]
            length += end["own"]
        else:
            conv, length, sums = end["conv_id"], end["own"], values
    names = ["task", "from_conv", "from_length"] + [f"s{i}" for i in LANES] + [f"w{i}" for i in LANES]
    schema = T.StructType([T.StructField(name, T.LongType()) for name in names])
    return turns.sparkSession.createDataFrame(rows, schema)


def read_turns(conversations: DataFrame, seed: int = 1) -> DataFrame:
    """Every turn: reference ``ref``, ``conv_id``, ``pos`` from 1, role, text, element, the pair of the
    conversation up to the turn (``f``) and before it (``x``)."""
    rows = located(conversations.select("conv_id", "turn", "role", "text"))
    rows = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        text_column("role").alias("role"),
        text_column().alias("text"),
        F.col("turn").cast("long").alias("turn"),
        *ROW,
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text", *ROW]
    longs = ", ".join(f"{c} long" for c in ["task", "at", "own", "n_bytes", *_E, *_F, *_X])
    ordered = rows.orderBy(*order).select("conv_id", "role", "text")
    turns = ordered.mapInArrow(_scan(seed), f"conv_id long, role string, text string, {longs}")
    turns = stage(turns, "trie-turns")
    met = turns.join(F.broadcast(_carries(turns, seed)), "task")
    goes_on = F.coalesce(F.col("conv_id") == F.col("from_conv"), F.lit(False))

    def whole(names):
        return [
            F.when(goes_on, _composed(F.col(f"s{i}"), F.col(f"w{i}"), F.col(name), i))
            .otherwise(F.col(name))
            .alias(name)
            for i, name in enumerate(names)
        ]

    return met.select(
        F.shiftleft("task", AT_BITS).bitwiseOR(F.col("at")).alias("ref"),
        "conv_id",
        (F.col("own") + F.when(goes_on, F.col("from_length")).otherwise(0)).alias("pos"),
        "role",
        "text",
        "n_bytes",
        *_E,
        *whole(_F),
        *whole(_X),
    )


def head_length(conv_id: str = "conv_id") -> Column:
    """How many turns of the head a conversation takes at most."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS).cast("int")


def rebuild(turns: DataFrame, seed: int) -> DataFrame:
    """A row for each rebuilt conversation and depth.

    ``conv_id``, ``depth``, ``length`` (of the whole), prefix ``f``, parent's prefix ``x``, and the last
    turn: ``ref``, ``n_bytes``, element ``e``. Depth 0 is the root's row.
    """
    turn = turns.withColumn("h", head_length())
    at_cut = [F.max(F.when(F.col("pos") == F.col("h"), F.col(f))).alias(f"a{i}") for i, f in enumerate(_F)]
    own = turn.groupBy("conv_id", "h").agg(F.max("pos").alias("own_length"), *at_cut)
    # At most HEADS - 1 rows for each conversation.
    last = F.struct("pos", "ref", "n_bytes", *_E, *_F, *_X)
    heads = (
        turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(last)).alias("head"))
    )
    met = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(
        heads.withColumnRenamed("conv_id", "base"), "base", "left"
    )
    empty = F.array().cast(heads.schema["head"].dataType)
    met = met.withColumn("head", F.slice(F.coalesce("head", empty), F.lit(1), F.col("h")))
    met = met.withColumn("taken", F.size("head"))
    suffix = F.greatest(F.col("own_length") - F.col("h"), F.lit(0))
    lanes = []
    for i, (prime, base) in enumerate(zip(PRIMES, bases(seed))):
        # The own turns' places move down by what the head lacks.
        inverse = pow(base, -1, prime)
        moved = F.array(*(F.lit(pow(inverse, k, prime)) for k in range(HEADS)))
        power = F.element_at(moved, F.col("h") - F.col("taken") + 1).cast("long")
        before = F.coalesce(F.get("head", F.col("taken") - 1)[f"f{i}"], F.lit(0))
        cut = F.coalesce(F.col(f"a{i}"), F.lit(0))
        lanes += [
            power.alias(f"m{i}"),
            F.pmod(before - power * cut % prime, F.lit(prime)).alias(f"d{i}"),
        ]
    plan = stage(
        met.select(
            "conv_id", "h", "taken", (F.col("taken") + suffix).cast("long").alias("length"), "head", *lanes
        ),
        "trie-plan",
    )
    out = ["conv_id", "depth", "length", "ref", "n_bytes", *_E, *_F, *_X]
    none = F.lit(None).cast("long")
    zero = [F.lit(0).cast("long").alias(c) for c in ["n_bytes", *_E, *_F, *_X]]
    roots = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", none.alias("ref"), *zero)
    from_head = plan.select("conv_id", "length", F.inline("head")).withColumnRenamed("pos", "depth")
    ahead = plan.filter("length > taken").drop("head")
    rest = attach(turns.drop("role", "text"), ahead, "conv_id").filter("pos > h")
    moved = [
        _composed(F.col(f"d{i}"), F.col(f"m{i}"), F.col(name), i).alias(name)
        for names in (_F, _X)
        for i, name in enumerate(names)
    ]
    depth = (F.col("pos") - F.col("h") + F.col("taken")).alias("depth")
    suffixes = rest.select("conv_id", depth, "length", "ref", "n_bytes", *_E, *moved)
    return stage(
        roots.select(*out).unionByName(from_head.select(*out)).unionByName(suffixes.select(*out)),
        "trie-rows",
    )


def _differ(names: list[str]) -> Column:
    return F.greatest(*((F.min(c) != F.max(c)).cast("int") for c in names)) == 1


def turns_differ(turns: DataFrame) -> bool:
    """Whether two turns of one element differ in role or text, by comparing those."""
    counted = turns.groupBy(*_E).agg(F.count(F.lit(1)).alias("n"))
    repeated = counted.filter("n > 1").select(F.xxhash64(*_E).alias("element"))
    met = attach(turns.withColumn("element", F.xxhash64(*_E)), repeated, "element", "left_semi")
    return not met.groupBy(*_E).agg(_differ(["role", "text"]).alias("bad")).filter("bad").isEmpty()


def groups(rows: DataFrame) -> DataFrame:
    """A row for each prefix; ``bad`` says that its members' last turns or parents differ."""
    return stage(
        rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.sum((F.col("depth") == F.col("length")).cast("long")).alias("n_ends"),
            F.max("n_bytes").alias("n_bytes"),
            F.min("ref").alias("ref"),
            *(F.min(x).alias(p) for x, p in zip(_X, _P)),
            _differ(_E + _X).alias("bad"),
        ),
        "trie-groups",
    )


def _digests(batches):
    """The hash of each group's joined pieces, which come in order."""
    key, digest, rows = None, None, []

    def done():
        return pa.RecordBatch.from_pylist(
            [dict(zip([*KEY, "ends_sha256"], row)) for row in rows],
            pa.schema([(c, pa.int64()) for c in KEY] + [("ends_sha256", pa.string())]),
        )

    for batch in batches:
        for *own, ids in zip(*(batch.column(i).to_pylist() for i in range(len(KEY) + 1))):
            if own == key:
                digest.update(b",")
            else:
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            digest.update(ids.encode())
        yield done()
        rows = []
    if key is not None:
        rows = [(*key, digest.hexdigest())]
        yield done()


def ends(rows: DataFrame) -> DataFrame:
    """Per prefix that ends a conversation, the hash of the ids that end there, ascending.

    A hash runs over one list in order; the list is joined in pieces of at most ``PIECE`` ids
    in parallel, and one task streams through the pieces without holding them.
    """
    block = F.floor(F.col("conv_id") / PIECE).alias("block")
    ids = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    pieces = rows.filter("depth = length").groupBy(*KEY, block).agg(F.array_join(ids, ",").alias("ids"))
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    schema = ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string"
    return dealt.mapInArrow(_digests, schema)


def nodes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The trie's nodes with their counts over subtrees; ``found`` are the ``groups`` of ``rows``."""
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("long")
    node = found.select(
        *KEY, *_P, "conv_id", "n_convs", "ref", saved.alias("saved"), leaf.alias("leaf")
    )
    # Of each conversation that names nodes: the sums along its path, and where the path begins.
    paths = node.groupBy("conv_id").agg(
        F.sum("saved").alias("path_saved"), F.sum("leaf").alias("path_leaves"), F.min("depth").alias("top")
    )
    paths = stage(paths, "trie-paths")
    none = F.lit(0).cast("long")
    members = attach(rows.select("conv_id", *KEY), paths, "conv_id").select(
        *KEY, F.col("path_saved").alias("saved"), F.col("path_leaves").alias("leaves"), none.alias("children")
    )
    up = node.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"),
        *(F.col(p).alias(f) for p, f in zip(_P, _F)),
        none.alias("saved"),
        none.alias("leaves"),
        F.lit(1).cast("long").alias("children"),
    )
    sums = members.unionByName(up).groupBy(*KEY).agg(
        F.sum("saved").alias("all_saved"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children")
    )
    above = running_before(node.select("conv_id", "depth", "saved"), "conv_id", "depth", "saved", PIECE)
    above = above.withColumnRenamed("before", "above").select("conv_id", "depth", "above")
    # Only the top of a path has a parent that another conversation names.
    tops = node.join(paths.select("conv_id", F.col("top").alias("depth")), ["conv_id", "depth"])
    link = F.xxhash64(F.col("depth") - 1, *_P)
    parents = stage(node.select(F.col("conv_id").alias("parent_conv_id"), *KEY), "trie-parents")
    parents = parents.select(
        F.xxhash64(*KEY).alias("link"),
        "parent_conv_id",
        (F.col("depth") + 1).alias("child_depth"),
        *(F.col(f).alias(f"of_{p}") for f, p in zip(_F, _P)),
    )
    children = tops.filter("depth > 0").select("conv_id", "depth", *_P, link.alias("link"))
    same = F.col("child_depth") == F.col("depth")
    for p in _P:
        same = same & (F.col(f"of_{p}") == F.col(p))
    named = attach(children, parents, "link").filter(same).select("conv_id", "depth", "parent_conv_id")
    whole = (
        node.join(sums, KEY)
        .join(ends(rows), KEY, "left")
        .join(above, ["conv_id", "depth"])
        .join(named, ["conv_id", "depth"], "left")
    )
    own_parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    return whole.select(
        "conv_id",
        "depth",
        own_parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("all_saved") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        F.col("ref").alias("turn_ref"),
    )


def trie(conversations: DataFrame, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """The nodes, and the turns that their ``turn_ref`` names by ``ref``."""
    while True:
        turns = read_turns(conversations, seed)
        rows = rebuild(turns, seed)
        found = groups(rows)
        if found.filter("bad").isEmpty() and not turns_differ(turns):
            return nodes(rows, found), turns
        seed += 1
