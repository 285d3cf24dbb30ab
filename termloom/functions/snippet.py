"""Snippets around the first hit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points shown before and after the hit.
BEFORE = 40
AFTER = 80


def snippet(text: Column, terms: Column) -> Column:
    """A window of ``text`` around the earliest occurrence of any of ``terms``.

    Terms match as substrings of the lowercased text; ties go to the first term in query order.
    Null when there is no text, no term or no occurrence.
    """

    def window(lowered: Column) -> Column:
        found = F.filter(
            F.transform(
                terms,
                lambda term, i: F.struct(
                    F.instr(lowered, F.lower(term)).alias("position"),
                    i.alias("query_order"),
                    F.char_length(term).alias("length"),
                ),
            ),
            lambda hit: hit["position"] > 0,
        )
        return F.array_min(found)

    # The one-element array lowercases the text once and not once per term.
    hit = F.get(F.transform(F.array(F.lower(text)), window), F.lit(0))
    start = F.greatest(hit["position"] - 1 - BEFORE, F.lit(0))
    end = hit["position"] - 1 + hit["length"] + AFTER
    return F.when(
        (F.char_length(text) > 0) & hit.isNotNull(), F.substring(text, start + 1, end - start)
    )
