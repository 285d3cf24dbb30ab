"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at the positions a mask leaves open, five or, for items of under
``LONG`` words, four; the other positions in its span may hold anything, so a substituted word
costs some seeds and not all. Every position of every document gives one seed per mask, which is
looked up among the benchmark's seeds. A hit
fixes how the document lies along the item; word by word comparison along that diagonal must
then find a window of ``WINDOW`` words (the whole item if it is shorter) of which ``AGREEING``
are equal.

The benchmark's different texts are looked up once, however many items have them, and their seeds
are broadcast in blocks of texts of a measured size, one pass and one job per block, so a benchmark
of any size works. Words are hashed once a document, and a row that looks up seeds has the hashes of
``PIECE`` words and not the document's words. Generated code holds all rows that it makes of a row
until the last of them, so what a task holds follows neither the length of a document nor the hits
in it. Hits are two numbers and the document's place; each different one is kept once and written.
Only the texts with hits are read again and meet them, each hit taking the words along its item.
What is found for an item does not depend on the other items.

Nulls and repeats: a null text is empty. Items of fewer than five words are too short for
evidence and are ignored. Words are lowercased runs of letters and digits. Repeated rows are
judged alike, each by itself; a null id is a value like others. Extra columns play no part.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, once, text_column, without
from termloom.plans.joins import attach, fits_broadcast
from termloom.plans.staging import stage

# Words looked at are marked 1. With these an item of LONG words or more is found wherever
# AGREEING of a window agree.
MASKS = ("1101011", "1011101", "11100101")
LONG = 11
# For shorter items, down to LEAST words; any one substitution (two in ten words) is tolerated.
SHORT_MASKS = ("1111", "10111", "11011", "11101")
LEAST = 5
WINDOW = 13
AGREEING = 0.8
# Seeds of one broadcast block, of at most about 100 bytes each.
BLOCK_SEEDS = 400_000
# Positions of a document that are looked up from one row.
PIECE = 1024
# What a hit is, besides its document's place.
HIT = ("doc_id", "item", "item_size", "start")
# Texts of items are broadcast below this; as arrays of words they take some three times as much.
ITEM_BYTES = 16 << 20


def words(text: Column) -> Column:
    """Lowercased words; a text that starts or ends otherwise has an empty word there."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)


def hashed(array: Column) -> Column:
    return F.transform(array, lambda word: F.xxhash64(word))


def _rotated(value: Column, bits: int) -> Column:
    if not bits:
        return value
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def seed(mask: str, at: Column) -> Column:
    """The seed of ``hashes`` at a position; null if the mask reaches beyond the last word."""
    value = None
    for number, i in enumerate(i for i, c in enumerate(mask) if c == "1"):
        word = _rotated(F.get("hashes", at + i), 13 * number)
        value = word if value is None else value.bitwiseXOR(word)
    return value


def items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``item_words`` and a key of its own for each different text."""
    trimmed = F.array_remove(words(text_column()), "")
    rows = benchmark.select("item_id", trimmed.alias("item_words"))
    rows = rows.filter(F.size("item_words") >= LEAST).distinct()
    return rows.withColumn("item", F.xxhash64(F.concat_ws(" ", "item_words")))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item that overlap.

    ``doc_id``, place, ``item_id``, ``start`` (word of the document at which the item would begin),
    ``agreeing`` (equal words in the best window) and ``covered`` (share of the item's words found).
    """
    all_items = stage(items(benchmark), "items")
    found = _best(_overlaps(located(docs), all_items), "item")
    found = attach(found, all_items.select("item", "item_id"), "item")
    return _best(found, "item_id").select("doc_id", *ROW, "item_id", "start", "agreeing", "covered")


def _best(found: DataFrame, key: str) -> DataFrame:
    """The best overlap of each document row and ``key``."""
    best = F.max(F.struct("agreeing", "covered", "start")).alias("best")
    return found.groupBy("doc_id", *ROW, key).agg(best).select("doc_id", *ROW, key, "best.*")


def _overlaps(placed: DataFrame, all_items: DataFrame) -> DataFrame:
    """``doc_id``, place, ``item``, ``start``, ``agreeing`` and ``covered`` of what is confirmed."""
    texts = stage(all_items.select("item", "item_words").distinct(), "item-texts")
    pieces = _pieces(placed)
    size = F.size("item_words")
    parts = []
    for masks, own in ((MASKS, texts.filter(size >= LONG)), (SHORT_MASKS, texts.filter(size < LONG))):
        total = own.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
        blocks = -(-total * len(masks) // BLOCK_SEEDS)
        # Long items are looked for even if there are none, so that there is a result.
        for block in range(max(blocks, masks is MASKS)):
            known = own.filter(F.pmod("item", F.lit(max(blocks, 1))) == block)
            parts.append(stage(_hits(pieces, known, masks).distinct(), "hits"))
    return _confirmed(placed, functools.reduce(DataFrame.unionByName, parts), texts)


def _pieces(placed: DataFrame) -> DataFrame:
    """``doc_id``, place, and ``hashes`` of ``PIECE`` words from ``base`` on, and of those that a mask
    reaches beyond them."""
    reach = max(len(mask) for mask in (*MASKS, *SHORT_MASKS)) - 1
    hashes = once(hashed(words(text_column()))).alias("hashes")
    read = placed.select(F.col("doc_id").cast("long"), *ROW, hashes)
    cut = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - 1, F.lit(PIECE)),
        lambda base: F.struct(
            base.alias("base"), F.slice("hashes", base + 1, PIECE + reach).alias("hashes")
        ),
    )
    return read.select("doc_id", *ROW, F.inline(cut))


def _hits(pieces: DataFrame, own: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``doc_id``, place, ``item``, its ``item_size`` and ``start`` for every seed that is found."""
    known = own.select("item", hashed(F.col("item_words")).alias("hashes"))
    known = known.select(
        "item", F.size("hashes").alias("item_size"), "hashes", F.posexplode("hashes").alias("item_at", "hash")
    )
    looked = pieces.select("*", F.posexplode("hashes").alias("at", "hash")).filter(F.col("at") < PIECE)
    places = []
    for number, mask in enumerate(masks):
        name, place = f"seed{number}", f"places{number}"
        seeds = known.select(
            seed(mask, F.col("item_at")).alias(name), F.struct("item", "item_size", "item_at").alias("place")
        )
        listed = seeds.filter(F.col(name).isNotNull()).groupBy(name).agg(F.collect_list("place").alias(place))
        looked = looked.withColumn(name, seed(mask, F.col("at"))).join(F.broadcast(listed), name, "left")
        places.append(place)
    hit = functools.reduce(Column.__or__, (F.col(place).isNotNull() for place in places))
    none = F.array().cast("array<struct<item: bigint, item_size: int, item_at: int>>")
    # A transformed array is listed row by row, outside of generated code.
    met = F.transform(
        F.concat(*(F.coalesce(F.col(place), none) for place in places)),
        lambda place: F.struct(
            place["item"].alias("item"),
            place["item_size"].alias("item_size"),
            (F.col("base") + F.col("at") - place["item_at"]).alias("start"),
        ),
    )
    return looked.filter(hit).select("doc_id", *ROW, F.inline(met))


def _confirmed(placed: DataFrame, hits: DataFrame, texts: DataFrame) -> DataFrame:
    texts_of = placed.select(*ROW, "text")
    array = once(words(text_column())).alias("words")
    if fits_broadcast(hits):
        # The hits go to the texts, which do not move.
        listed = hits.groupBy(*ROW).agg(F.collect_list(F.struct(*HIT)).alias("hits"))
        read = texts_of.join(F.broadcast(listed), list(ROW)).select(*ROW, "hits", array)
        each = F.transform("hits", lambda hit: F.struct(*(hit[name].alias(name) for name in HIT)))
        met = read.select(*ROW, "words", F.inline(each))
    else:
        wanted = hits.select(*ROW).distinct()
        if fits_broadcast(wanted):
            wanted = F.broadcast(wanted)
        read = texts_of.join(wanted, list(ROW), "left_semi").select(*ROW, array)
        # By sorted rows, a hit at a time meets its text.
        met = hits.join(read.hint("merge"), list(ROW))
    # Only the words along the item go on.
    start = F.col("start")
    along = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("item_size") + F.least(start, F.lit(0)))
    met = met.select("doc_id", *ROW, "item", "start", along.alias("along"))
    met = attach(met, texts, "item", broadcast_bytes=ITEM_BYTES)
    equal = F.transform(
        F.col("item_words"),
        lambda word, i: F.coalesce(F.get("along", F.least(start, F.lit(0)) + i) == word, F.lit(False)),
    )
    window = F.least(F.lit(WINDOW), F.size("equal"))
    counts = F.transform(
        F.sequence(F.lit(1), F.size("equal") - window + 1),
        lambda i: F.size(F.filter(F.slice("equal", i, window), lambda same: same)),
    )
    checked = met.select("doc_id", *ROW, "item", "start", once(equal).alias("equal"))
    checked = checked.select("*", once(F.array_max(counts)).alias("agreeing"))
    covered = F.size(F.filter("equal", lambda same: same)) / F.size("equal")
    return checked.filter(F.col("agreeing") >= F.ceil(AGREEING * window)).select(
        "doc_id", *ROW, "item", "start", "agreeing", covered.alias("covered")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns unchanged, without the rows that overlap an item."""
    placed = located(docs)
    return without(placed, _overlaps(placed, items(benchmark)).select(*ROW).distinct())
