"""Text normalisation and the three tokenizers, as column expressions."""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.unicode import ascii_fold, nfc

# The default stopword list.
DEFAULT_STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "has", "he", "in", "is",
    "it", "its", "of", "on", "or", "that", "the", "to", "was", "were", "will", "with",
)

# Characters read as an apostrophe.
APOSTROPHES = "\u2019\u2018\u02bc"

LETTER_OR_DIGIT = r"\p{L}\p{N}"
WORD = rf"[{LETTER_OR_DIGIT}]+"
# U+02BC is a letter by category but counts as an apostrophe, hence as a separator.
WORD_WITHOUT_APOSTROPHE = rf"[{LETTER_OR_DIGIT}&&[^\x{{2bc}}]]+"
# Apostrophes at a word's edge.
EDGE_APOSTROPHES = rf"(^|[^{LETTER_OR_DIGIT}])'+|'+([^{LETTER_OR_DIGIT}]|$)"
ASCII_WORD = "[a-z0-9]+"

MODES = ("unicode", "simple", "ascii")


@dataclass(frozen=True)
class TokenOptions:
    """How to cut a text into tokens.

    ``mode`` is ``unicode`` (normalise, then cut), ``simple`` (lowercase, runs of letters and
    digits, no normalisation) or ``ascii`` (runs of ASCII letters and digits). The options after
    it belong to ``unicode``. Lengths count code points. ``assume_nfc`` skips normalisation for
    a corpus known to be in NFC.
    """

    mode: str = "unicode"
    lowercase: bool = True
    ascii_fold: bool = False
    preserve_apostrophes: bool = False
    remove_stopwords: bool = False
    stopwords: Iterable[str] | None = None
    min_length: int = 1
    assume_nfc: bool = False

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if self.stopwords is not None:
            if not isinstance(self.stopwords, (set, frozenset, list, tuple)):
                raise TypeError("stopwords must be a set or a list of strings")
            object.__setattr__(self, "stopwords", tuple(sorted(set(self.stopwords))))


DEFAULT_OPTIONS = TokenOptions()
# Queries are cut like the default index, whatever stopwords or folding an index used.
QUERY_OPTIONS = TokenOptions()


def _prepared(text: Column, options: TokenOptions) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    if options.ascii_fold:
        text = ascii_fold(text)
    elif not options.assume_nfc:
        text = nfc(text)
    return F.lower(text) if options.lowercase else text


def normalize_text(text: Column, options: TokenOptions = DEFAULT_OPTIONS) -> Column:
    """One line of words separated by single spaces; null becomes the empty string."""
    text = F.translate(_prepared(text, options), APOSTROPHES, "'" * len(APOSTROPHES))
    kept = LETTER_OR_DIGIT + ("'" if options.preserve_apostrophes else "")
    text = F.regexp_replace(text, f"[^{kept}]+", " ")
    if options.preserve_apostrophes:
        text = F.regexp_replace(text, EDGE_APOSTROPHES, "$1$2")
        text = F.regexp_replace(text, "'+", "'")
        # Dropping a lone apostrophe can leave two spaces in a row.
        text = F.regexp_replace(text, " +", " ")
    return F.trim(text)


def _unicode_tokens(text: Column, options: TokenOptions) -> Column:
    if options.preserve_apostrophes:
        words = F.split(normalize_text(text, options), " ")
    else:
        words = F.regexp_extract_all(
            _prepared(text, options), F.lit(WORD_WITHOUT_APOSTROPHE), F.lit(0)
        )
    # Extracted words have a letter at least; splitting an empty text yields one empty word.
    shortest = max(options.min_length, 1)
    if shortest > 1 or options.preserve_apostrophes:
        words = F.filter(words, lambda word: F.char_length(word) >= shortest)
    if options.remove_stopwords:
        stopwords = DEFAULT_STOPWORDS if options.stopwords is None else options.stopwords
        if stopwords:
            # Catalyst turns a literal list this long into a hash-set lookup.
            words = F.filter(words, lambda word: ~word.isin(*stopwords))
    return words


def tokenize(text: Column, options: TokenOptions = DEFAULT_OPTIONS) -> Column:
    """The tokens of a text, in order and with duplicates."""
    if options.mode == "simple":
        lowered = F.lower(F.coalesce(text.cast("string"), F.lit("")))
        return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
    if options.mode == "ascii":
        # Only ASCII letters are lowered: others separate, whatever their lowercase is.
        lowered = F.translate(
            F.coalesce(text.cast("string"), F.lit("")),
            string.ascii_uppercase,
            string.ascii_lowercase,
        )
        return F.regexp_extract_all(lowered, F.lit(ASCII_WORD), F.lit(0))
    return _unicode_tokens(text, options)


def title_and_body(title: Column, body: Column) -> Column:
    """The text the ``ascii`` tokenizer indexes: null if either part is null."""
    return F.concat(title, F.lit(" "), body)


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of a token list, without leaving the row.

    Equal tokens are neighbours after sorting, so the starts of the runs give the terms and the
    distances between them the counts: O(n log n) per text and no shuffle. Sorting happens once,
    in the one-element array that the outer ``transform`` binds.
    """

    def runs(words: Column) -> Column:
        size = F.size(words)
        positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1))
        )
        return F.get(
            F.transform(
                F.array(starts),
                lambda s: F.transform(
                    s,
                    lambda start, i: F.struct(
                        F.get(words, start).alias("term"),
                        (F.coalesce(F.get(s, i + 1), size) - start).alias("tf"),
                    ),
                ),
            ),
            F.lit(0),
        )

    return F.get(F.transform(F.array(F.sort_array(tokens)), runs), F.lit(0))
