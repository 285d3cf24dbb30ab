"""Unicode normalisation, the one text step Spark SQL has no function for.

The Arrow UDFs are fed only the texts that can change: a code-point test in the JVM nulls out
every text that is certainly normalised already, so Latin corpora never cross into Python.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Code-point ranges in which every character is its own NFC form, has combining
# class 0 and never composes with the character before it. A text made of these only is NFC.
NFC_STABLE_RANGES = (
    (0x0000, 0x02FF),  # Latin
    (0x0388, 0x03FF),  # Greek
    (0x0400, 0x0482),  # Cyrillic
    (0x048A, 0x052F),
    (0x05D0, 0x05EA),  # Hebrew letters
    (0x0606, 0x060F),  # Arabic punctuation and letters
    (0x061B, 0x064A),
    (0x1E00, 0x1EFF),  # Latin, additional
    (0x2010, 0x2027),  # dashes, quotation marks
    (0x20A0, 0x20BF),  # currency signs
    (0x3001, 0x3029),  # CJK punctuation
    (0x3041, 0x3096),  # Hiragana letters
    (0x30A1, 0x30FA),  # Katakana letters
    (0x3400, 0x9FFF),  # CJK ideographs
    (0xAC00, 0xD7A3),  # Hangul syllables
    (0xFF01, 0xFFEE),  # half and full width forms
    (0x1F300, 0x1FAFF),  # pictographs
)

# The combining marks that folding deletes.
FIRST_MARK, LAST_MARK = 0x300, 0x36F


def _class(ranges) -> str:
    return "[" + "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in ranges) + "]"


def _gaps(ranges) -> list[tuple[int, int]]:
    starts = [last + 1 for _, last in ranges]
    ends = [first - 1 for first, _ in ranges[1:]] + [0x10FFFF]
    return [(start, end) for start, end in zip(starts, ends) if start <= end]


# The first test is one comparison per character and settles Latin text. The second spells the
# complement out as ranges: the regex engine is several times slower on a long negated class.
BEYOND_LATIN = _class(_gaps(NFC_STABLE_RANGES[:1]))
MAY_CHANGE_NFC = _class(_gaps(NFC_STABLE_RANGES))


def _folded(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not FIRST_MARK <= ord(c) <= LAST_MARK)


# Latin letters that fold to one character are folded in the JVM, by a table made from the rule.
_LATIN_FOLDS = {chr(p): _folded(chr(p)) for p in range(0x250) if len(_folded(chr(p))) == 1}
FOLD_FROM = "".join(c for c, folded in _LATIN_FOLDS.items() if c != folded)
FOLD_TO = "".join(folded for c, folded in _LATIN_FOLDS.items() if c != folded)
FOLDS_ELSEWHERE = _class(_gaps([(ord(c), ord(c)) for c in _LATIN_FOLDS]))


def _normalizer(form: str, first_dropped: int = 1, last_dropped: int = 0):
    """An Arrow UDF; defined inside so that it is shipped by value to the Python workers."""

    @F.arrow_udf(StringType())
    def normalize(texts: pa.Array) -> pa.Array:
        dropped = dict.fromkeys(range(first_dropped, last_dropped + 1))
        done = (t if t is None else unicodedata.normalize(form, t) for t in texts.to_pylist())
        return pa.array(
            [t.translate(dropped) if t and dropped else t for t in done], pa.string()
        )

    return normalize


def nfc(text: Column) -> Column:
    """Canonical composition."""
    needed = text.rlike(BEYOND_LATIN) & text.rlike(MAY_CHANGE_NFC)
    return F.coalesce(_normalizer("NFC")(F.when(needed, text)), text)


def ascii_fold(text: Column) -> Column:
    """Compatibility decomposition with the combining marks deleted (``é`` -> ``e``).

    The result is the same whether or not the text was composed before.
    """
    fold = _normalizer("NFKD", FIRST_MARK, LAST_MARK)
    needed = text.rlike(FOLDS_ELSEWHERE)
    return F.coalesce(fold(F.when(needed, text)), F.translate(text, FOLD_FROM, FOLD_TO))
