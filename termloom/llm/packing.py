"""Best-fit packing of tokenised documents by hierarchical residual merging.

Round 0 reads the documents once: a task turns texts into token ids, cuts the longer documents
into pieces, and packs its pieces best-fit decreasing, ``LOCAL_PIECES`` at a time. Only lengths,
checksums and places are written. Then bins are the items: those that are nearly full, or so
full that not even the smallest open bin fits, are done; the open ones are dealt at random over
tasks of ``GROUP_BINS`` and packed best-fit decreasing again, round after round, until one task
can hold them all or a round saves less than one bin in a hundred. A round moves one row per open
bin; the pieces' final places come from joining the rounds' moves.

Token ids come from the tokenizer itself, which cuts a text before its merges and drops white
space. Each distinct cut is encoded once per worker, and what lies between white space is looked up
whole (in a bounded memo); this gives the same ids as encoding the whole text. Texts with
characters for which the cutting rule here might differ go through the tokenizer whole.

Nulls and repeats: a null text is empty and gives one piece holding only the separator. Null ids and
repeated rows are packed like others. Extra columns play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import giving_back, kept, text_column
from termloom.plans.staging import small_batches, stage

CAPACITY = 2048
SEPARATOR = 0
NEARLY_FULL = CAPACITY - 4
LOCAL_PIECES = 1 << 16
GROUP_BINS = 50_000
LEAST_GAIN = 0.01
MEMO_CHUNKS = 400_000
# Chunks that a worker keeps between tasks, whatever they belong to.
KEPT_CHUNKS = 200_000
# Characters of text handled between look-ups of new words.
SUB_BATCH = 1 << 20

# The cutting rule of the vocabulary, for texts without the characters below.
CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# Characters that classes of Python and of the tokenizer may judge apart, that its normaliser may
# change, or that open its special strings.
UNSURE_NARROW = (b"<|", *(bytes([c]) for c in (*range(0x1C, 0x20), 0xB2, 0xB3, 0xB9, *range(0xBC, 0xBF))))
UNSURE = re.compile(
    r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0130\u0250-\u200f\u2028-\u202f\u205f-\U0010ffff]|<\|"
)


def unsure(text: str) -> bool:
    try:
        narrow = text.encode("latin-1")
    except UnicodeEncodeError:
        return UNSURE.search(text) is not None
    return any(mark in narrow for mark in UNSURE_NARROW)


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.memo: dict[str, bytes] = {}

    def _learn(self, chunks: set[str]) -> None:
        parts = {chunk: CUTS.findall(chunk) for chunk in chunks}
        cuts = sorted(set(chain.from_iterable(parts.values())).difference(self.memo))
        lines = [" ".join(cuts[i : i + 256]) for i in range(0, len(cuts), 256)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in encoded), np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        data, at = ids.tobytes(), 0
        for cut, stop in zip(cuts, (4 * stops).tolist(), strict=True):
            self.memo[cut] = data[at:stop]
            at = stop
        for chunk, found in parts.items():
            if len(found) > 1:
                self.memo[chunk] = b"".join(map(self.memo.__getitem__, found))

    def forget(self, limit: int) -> None:
        """Keeps what was met first, which is met most often."""
        if len(self.memo) > limit:
            self.memo = dict(islice(self.memo.items(), limit))

    def encode(self, texts: list[str]) -> list[bytes]:
        chunks = [None if unsure(t) else t.lower().split() for t in texts]
        wanted = set(chain.from_iterable(c for c in chunks if c))
        new = wanted.difference(self.memo)
        if new:
            if len(self.memo) + len(new) > MEMO_CHUNKS:
                self.forget(MEMO_CHUNKS // 2)
                new = wanted.difference(self.memo)
            self._learn(new)
        ids = self.memo.__getitem__
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32).tobytes()
            if c is None
            else b"".join(map(ids, c))
            for t, c in zip(texts, chunks)
        ]


def word_ids(definition: str) -> WordIds:
    """One encoder a worker, which keeps what it has learnt from task to task."""
    return kept("packing", definition, lambda: WordIds(definition))


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, largest items first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Bit r is set while a bin with room r exists.
    rooms, count = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, count = capacity, count, count + 1
        bins[i], offsets[i] = chosen, capacity - room
        if room > size:
            if not by_room[room - size]:
                rooms |= 1 << (room - size)
            by_room[room - size].append(chosen)
    return bins, offsets


def _sub_batches(texts: list[str]):
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= SUB_BATCH:
            yield texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield texts[first:]


def _pieces(definition):
    separator = np.array([SEPARATOR], np.uint32).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]

    def run(batches):
        encoder = word_ids(definition.value)
        task, chunk = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def packed():
            columns = [np.array(c) for c in list(zip(*rows))[1:]]
            bins, offsets = best_fit(columns[2])
            bins += (task << 36) | (chunk << 20)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    *(pa.array(c, k) for c, k in zip(columns, kinds)),
                    pa.array(bins),
                    pa.array(offsets),
                ],
                names,
            )

        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for texts in _sub_batches(batch.column(1).to_pylist()):
                for data in encoder.encode(texts):
                    data += separator
                    doc_id = next(ids)
                    for piece, at in enumerate(range(0, len(data), 4 * CAPACITY)):
                        part = data[at : at + 4 * CAPACITY]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                        if len(rows) == LOCAL_PIECES:
                            yield packed()
                            rows, chunk = [], chunk + 1
        encoder.forget(KEPT_CHUNKS)
        if rows:
            yield packed()

    return run


def _merge(round_number: int):
    def run(batches):
        batches = [b for b in batches if len(b)]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        bins, offsets = best_fit(table.column("size").to_numpy())
        bins += (round_number << 58) | (TaskContext.get().partitionId() << 20)
        yield pa.RecordBatch.from_arrays(
            [*(table.column(c).combine_chunks() for c in ("bin", "size")), pa.array(bins), pa.array(offsets)],
            ["bin", "size", "parent", "shift"],
        )

    return run


def moves(bins: DataFrame) -> list[DataFrame]:
    """Per round, where the open bins (``bin``, ``size``) go: ``bin``, ``parent``, ``shift``."""
    rounds: list[DataFrame] = []
    while True:
        nearly = bins.filter(F.col("size") < NEARLY_FULL)
        count, least = nearly.agg(F.count(F.lit(1)), F.min("size")).first()
        if count < 2:
            return rounds
        open_bins = nearly.filter(F.col("size") + least <= CAPACITY)
        groups = -(-count // GROUP_BINS)
        number = len(rounds) + 1
        dealt = open_bins.repartition(groups, F.xxhash64("bin", F.lit(number)))
        moved = dealt.mapInArrow(_merge(number), "bin long, size long, parent long, shift long")
        moved = stage(moved, "packing-round")
        rounds.append(moved.select("bin", "parent", "shift"))
        bins = moved.groupBy(F.col("parent").alias("bin")).agg(F.sum("size").alias("size"))
        before, after = moved.agg(F.count(F.lit(1)), F.count_distinct("parent")).first()
        if groups == 1 or before - after < LEAST_GAIN * before:
            return rounds


def pack(docs: DataFrame, definition: str) -> DataFrame:
    """The pieces of all documents and where they lie; ``definition`` is the tokenizer's JSON."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    pieces = texts.mapInArrow(
        giving_back(_pieces(shared), "packing"),
        "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long",
    )
    with small_batches(docs.sparkSession):
        pieces = stage(pieces, "packing-pieces")
    sizes = pieces.groupBy("bin").agg(F.sum("length").alias("size"))
    packed = pieces
    for moved in moves(sizes):
        packed = packed.join(moved, "bin", "left").select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            F.coalesce("parent", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return packed.withColumnRenamed("bin", "sequence_id")
