"""Secret scan with multipart credential linking.

Strong parts are found by their own form and always reported: assignments to a secret's name,
access keys, and long hex strings. Weak parts mean something only together: short identifiers
(user, client or key names with a value), secret-looking values without a name, and
endpoints. All parts become intervals of the text. An interval join over stretches of
``REACH`` characters, within the scope of one document, meets every weak part with the parts
at most ``REACH`` characters away, and a weak part is reported only if one of these
complements it: identifier with secret, endpoint with secret or identifier.
A weak part that overlaps a strong one is not reported.

Parts do not overlap within a kind and have a least length but no greatest, so a stretch holds a
bounded number of them, a text's parts lie in as many stretches as it has, and the join grows with
the text. Positions come from the lengths of the gaps and
matches, summed per document and kind. Only DataFrame operations; no Python on the executors.

Nulls and repeats: a null text is empty; a row without a finding has zero counts and empty
spans. Every row gives one row, whatever its id. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, text_column
from termloom.plans.staging import stage

REACH = 200
ACCESS_LENGTH = 20
VALUE_LENGTH = 6
HEX_LENGTH = 24

# The strong kinds' patterns. Runs are greedy, so a least length says the same as
# dropping shorter matches, except for assignments, whose short matches use up their text.
STRONG = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}",
    "hex": rf"[0-9a-f]{{{HEX_LENGTH},}}",
}
WEAK = {
    "weak_id": r"""(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "weak_secret": r"(?<![A-Za-z0-9/+_-])(?=[A-Za-z/+_-]*[0-9])(?=[0-9A-Z/+_-]*[a-z])(?=[0-9a-z/+_-]*[A-Z])[A-Za-z0-9/+_-]{32,}+",
    "endpoint": r"""\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]{3,}""",
}
KINDS = (*STRONG, *WEAK)
# What a weak part needs nearby, by kind.
SECRETS = ("assign", "hex", "weak_secret")
IDENTIFIERS = ("access", "weak_id")
COMPLEMENTS = {
    "weak_id": SECRETS,
    "weak_secret": IDENTIFIERS,
    "endpoint": SECRETS + IDENTIFIERS,
}
# A text without this has no match, which is cheaper to see than the pattern.
NEEDED = {"access": "AKIA", "endpoint": "://"}


def _spans(kind: str) -> Column:
    """Array of (kind, gap before, length, kept) of a kind's matches, in order."""
    text, pattern = F.col("text"), F.lit({**STRONG, **WEAK}[kind])
    number = F.lit(KINDS.index(kind))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    if kind == "assign":
        values = F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), F.char_length)
    else:
        values = F.transform(lengths, lambda _: F.lit(VALUE_LENGTH))
    zipped = F.arrays_zip(gaps.alias("gap"), lengths.alias("length"), values.alias("value"))
    found = F.transform(
        F.slice(zipped, 1, F.size(lengths)),
        lambda s: F.struct(
            number.alias("kind"),
            s["gap"].alias("gap"),
            s["length"].alias("length"),
            (s["value"] >= VALUE_LENGTH).alias("kept"),
        ),
    )
    none = F.array().cast("array<struct<kind: int, gap: int, length: int, kept: boolean>>")
    likely = F.contains(text, F.lit(NEEDED[kind])) if kind in NEEDED else F.rlike(text, pattern)
    return F.when(likely, found).otherwise(none)


def parts(placed: DataFrame) -> DataFrame:
    """All parts with code point positions; a document without any gives one row of nulls."""
    texts = placed.select(F.col("doc_id").cast("long"), *ROW, text_column().alias("text"))
    found = texts.select("doc_id", *ROW, F.concat(*map(_spans, KINDS)).alias("found"))
    rows = found.select("doc_id", *ROW, F.posexplode_outer("found").alias("number", "part"))
    rows = rows.select("doc_id", *ROW, "number", "part.*")
    order = Window.partitionBy(*ROW, "kind").orderBy("number")
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    rows = rows.withColumn("end", end)
    # A match that is dropped leaves its document's row.
    start = F.when(F.col("kept"), F.col("end") - F.col("length"))
    return rows.select(
        "doc_id",
        *ROW,
        F.when(F.col("kept"), F.col("kind")).alias("kind"),
        start.alias("start"),
        F.when(F.col("kept"), F.col("end")).alias("end"),
    )


def _stretches(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(first / REACH), F.floor(last / REACH)))


def linked(found: DataFrame) -> DataFrame:
    """The weak parts (place, ``kind``, ``start``, ``end``) that a complement nearby confirms."""
    number = {kind: i for i, kind in enumerate(KINDS)}
    weak = found.filter(F.col("kind") >= len(STRONG)).select(
        *ROW,
        "kind",
        "start",
        "end",
        _stretches(F.col("start") - REACH, F.col("end") + REACH).alias("stretch"),
    )
    others = found.filter("kind is not null").select(
        *ROW,
        F.col("kind").alias("other"),
        F.col("start").alias("other_start"),
        F.col("end").alias("other_end"),
        _stretches(F.col("start"), F.col("end")).alias("stretch"),
    )
    met = weak.join(others, [*ROW, "stretch"])
    apart = F.greatest(F.col("other_start") - F.col("end"), F.col("start") - F.col("other_end"))
    completes = F.lit(False)
    for kind, wanted in COMPLEMENTS.items():
        is_wanted = F.col("other").isin([number[w] for w in wanted])
        completes = completes | ((F.col("kind") == number[kind]) & is_wanted)
    return (
        met.groupBy(*ROW, "kind", "start", "end")
        .agg(
            F.max(completes & (apart >= 0) & (apart <= REACH)).alias("complete"),
            F.max((F.col("other") < len(STRONG)) & (apart < 0)).alias("covered"),
        )
        .filter("complete and not covered")
        .select(*ROW, "kind", "start", "end")
    )


def scan(docs: DataFrame) -> DataFrame:
    """Per row: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``n_linked``."""
    found = stage(parts(located(docs)), "secret-parts")
    weak = linked(found).withColumn("doc_id", F.lit(None).cast("long"))
    kept = found.filter(F.col("kind").isNull() | (F.col("kind") < len(STRONG)))
    # A document whose only parts are weak must keep a row.
    bare = found.filter(F.col("kind") >= len(STRONG)).select(
        "doc_id", *ROW, *(F.lit(None).cast("long").alias(c) for c in ("kind", "start", "end"))
    )
    rows = kept.unionByName(weak).unionByName(bare.distinct())
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind").cast("int") + 1)
    written = F.when(
        F.col("kind").isNotNull(),
        F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("span")),
    )
    is_base = F.col("kind") < len(STRONG)
    grouped = rows.groupBy(*ROW).agg(
        F.max("doc_id").alias("doc_id"),
        *(F.count_if(F.col("kind") == i).alias(f"n_{kind}") for i, kind in enumerate(STRONG)),
        F.sort_array(F.collect_list(F.when(is_base, written))).alias("base"),
        F.sort_array(F.collect_list(written)).alias("all"),
        F.count_if(~is_base).alias("n_linked"),
    )
    return grouped.select(
        "doc_id",
        *ROW,
        *(f"n_{kind}" for kind in STRONG),
        F.sha2(F.concat_ws(",", "base.span").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", "all.span").alias("spans"),
        "n_linked",
    )
