"""What the corpus operators share: row identity, Arrow helpers, size-checked joins."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.plans.joins import fits_broadcast
from termloom.plans.staging import stage

# A row's place: hash of its file's path, and its number in that file.
ROW = ("_file", "_at")

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Lowercased runs of letters and digits."""
    return WORD.findall(text.lower()) if text else []


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def once(column: Column) -> Column:
    """A column that later steps may use repeatedly without its being computed again."""
    return F.explode(F.array(column))


def located(docs: DataFrame, label: str = "located") -> DataFrame:
    """``docs`` with the columns of ``ROW``, which name each row even if ids repeat or are null.

    The place is that in the file, so it survives retries and is the same in every scan. A frame
    that is not a plain file scan is written to the shared folder first. Columns that are named
    like those of ``ROW`` are left out.
    """

    def place(frame: DataFrame) -> DataFrame:
        return frame.select(
            *frame.columns,
            F.xxhash64(F.col("_metadata.file_path")).alias(ROW[0]),
            F.col("_metadata.row_index").alias(ROW[1]),
        )

    clean = docs.drop(*ROW)
    try:
        return place(clean)
    except AnalysisException:
        return place(stage(clean, label))


def without(placed: DataFrame, dropped: DataFrame) -> DataFrame:
    """``placed`` less the rows whose ``ROW`` is in ``dropped``, and without ``ROW``.

    The dropped places are written, so that what finds them runs once and not for their measure
    too. They are broadcast only if they measure small; otherwise both sides shuffle.
    """
    dropped = stage(dropped.select(*ROW), "dropped")
    if fits_broadcast(dropped):
        dropped = F.broadcast(dropped)
    return placed.join(dropped, list(ROW), "left_anti").drop(*ROW)


def running_before(rows: DataFrame, group: str, order: str, value: str, piece: int) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over the group's rows of smaller ``order``.

    ``order`` is a whole number of which a group has each at most once. A window sees one
    piece of at most ``piece`` rows; the sums of whole pieces are added.
    """
    pieces = rows.withColumn("_piece", F.floor(F.col(order) / piece))
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, "_piece").orderBy(order).rowsBetween(*earlier)
    pieces = pieces.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    sums = pieces.groupBy(group, "_piece").agg(F.sum(value).alias("_sum"))
    across = F.sum("_sum").over(Window.partitionBy(group).orderBy("_piece").rowsBetween(*earlier))
    starts = sums.select(group, "_piece", across.alias("_start")).filter("_start <> 0")
    if fits_broadcast(starts):
        starts = F.broadcast(starts)
    before = F.col("_inside") + F.coalesce("_start", F.lit(0))
    met = pieces.join(starts, [group, "_piece"], "left")
    return met.select(*rows.columns, before.alias("before"))


def give_back() -> None:
    """Returns memory that was freed, but that the allocators of this process keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# What this process keeps from task to task: one operator's tables at a time.
_kept: dict[tuple[str, str], object] = {}


def kept(operator: str, name: str, make: Callable):
    """What ``make`` gives, kept until this worker gets a task of another operator."""
    if (operator, name) not in _kept:
        _kept.clear()
        _kept[operator, name] = make()
    return _kept[operator, name]


def giving_back(run: Callable, keeps: str | None = None) -> Callable:
    """``run`` over Arrow batches; as workers live on from task to task, what other operators than
    ``keeps`` have kept is dropped before the first one, and free memory is given back after the last."""

    def wrapped(batches):
        if any(operator != keeps for operator, _ in _kept):
            _kept.clear()
            give_back()
        yield from run(batches)
        give_back()

    return wrapped


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


# Longer texts are taken in pieces, cut at white space; and so many characters are worked on at once.
PIECE = 1 << 20
SUB_BATCH = 1 << 18


def pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        cut = max(text.rfind(space, at, end) for space in " \n\t")
        end = cut if cut > at else end
        yield text[at:end]
        at = end
    yield text[at:]


def sub_batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of texts and the numbers of their texts, about ``SUB_BATCH`` characters at a time."""
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        for part in pieces(text or ""):
            rows.append(row)
            parts.append(part)
            held += len(part)
            if held >= SUB_BATCH:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


@functools.cache
def _word_characters() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """The 64-bit hashes of every text's ``words``, in order.

    The characters of many texts are hashed at once: a word is the sum of its mixed characters times
    powers of a constant, mixed. A run over ``PIECE`` characters is cut there.
    """
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for rows, parts in sub_batches(texts):
        lowered = [part.lower() for part in parts]
        joined = "\n".join(lowered) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = _word_characters()[codes]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        starts, at = np.flatnonzero(begins), np.flatnonzero(inside)
        if not len(at):
            continue
        number = np.cumsum(begins[at]) - 1
        place = at - starts[number]
        powers = np.full(place.max() + 1, 0x9E3779B97F4A7C15, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        values = mix(codes[at]) * powers[place]
        hashes = mix(np.add.reduceat(values, np.flatnonzero(begins[at])))
        ends = np.cumsum([len(part) + 1 for part in lowered])
        cuts = np.searchsorted(starts, ends)
        for row, start, end in zip(rows, [0, *cuts[:-1].tolist()], cuts.tolist()):
            found[row].append(hashes[start:end])
    none = np.empty(0, np.uint64)
    return [own[0] if len(own) == 1 else np.concatenate([none, *own]) for own in found]
