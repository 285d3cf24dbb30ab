"""A deterministic synthetic corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.ids import external_id

# The topics and the shape of a document.
TOPICS = ("alpha", "beta", "gamma", "delta", "epsilon")
VOCABULARY = 2000
TITLE_WORDS = (4, 10)
BODY_WORDS = (60, 180)
BODY_TOPICS = 3

_PRIME = 2_147_483_647


def generate(ids: DataFrame, seed: str = "seed") -> DataFrame:
    """``number, external_id, title, body`` for every ``number`` in ``ids``.

    All draws of a document come from one digest of seed and number, so a document does not
    depend on the others and the corpus is generated wherever the ids are. One title word and up
    to three body words are replaced by the document's topic.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("number").cast("string")))

    def part(i: int) -> Column:
        # Seven hexadecimal digits: below 2^28, so the products below stay exact in a long.
        return F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("long")

    drawn = ids.select(
        "number",
        part(0).alias("a"),
        part(1).alias("b"),
        part(2).alias("c"),
        part(3).alias("d"),
    )

    def between(draw: Column, bounds: tuple[int, int]) -> Column:
        return (F.lit(bounds[0]) + draw % (bounds[1] - bounds[0] + 1)).cast("int")

    def word(i: Column) -> Column:
        step = (F.col("a") + i.cast("long") * F.col("b")) % _PRIME
        return F.concat(F.lit("w"), ((step * step) % _PRIME % VOCABULARY).cast("string"))

    def words(first: int, length: Column, topic_places: list[Column]) -> Column:
        def at(i: Column) -> Column:
            hit = F.lit(False)
            for place in topic_places:
                hit = hit | (i == place)
            return F.when(hit, F.col("topic")).otherwise(word(i + first))

        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), length - 1), at))

    sized = drawn.select(
        "*",
        F.element_at(F.array(*[F.lit(t) for t in TOPICS]), (F.col("c") % 5 + 1).cast("int")).alias(
            "topic"
        ),
        between(F.floor(F.col("c") / 5), TITLE_WORDS).alias("title_length"),
        between(F.col("d"), BODY_WORDS).alias("body_length"),
    )
    title_place = (F.floor(F.col("d") / 1000) % F.col("title_length")).cast("int")
    body_places = [
        (((F.col("c") + F.lit(k) * F.col("d")) % _PRIME) % F.col("body_length")).cast("int")
        for k in range(1, BODY_TOPICS + 1)
    ]
    return sized.select(
        "number",
        external_id(F.col("number")).alias("external_id"),
        words(0, F.col("title_length"), [title_place]).alias("title"),
        words(TITLE_WORDS[1], F.col("body_length"), body_places).alias("body"),
    )


def generate_range(spark, n: int, seed: str = "seed") -> DataFrame:
    """``n`` documents numbered from 0."""
    if n < 1:
        raise ValueError("n must be a positive integer")
    return generate(spark.range(n).select(F.col("id").alias("number")), seed)
