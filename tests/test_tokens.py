import unicodedata

import pytest
from pyspark.sql import functions as F

from termloom.functions.ids import external_id
from termloom.functions.snippet import snippet
from termloom.functions.text import (
    DEFAULT_STOPWORDS,
    TokenOptions,
    normalize_text,
    term_counts,
    tokenize,
)
from termloom.functions.unicode import NFC_STABLE_RANGES, ascii_fold, nfc


def one(spark, text, expression):
    row = spark.createDataFrame([(text,)], "text string").select(expression.alias("x")).first()
    return row["x"]


def cut(spark, text, **options):
    return one(spark, text, tokenize(F.col("text"), TokenOptions(**options)))


# Inputs and the tokens they must give.
GOLDEN = [
    ("Hello, world!!", {}, ["hello", "world"]),
    ("State-of-the-art systems", {}, ["state", "of", "the", "art", "systems"]),
    ("Café naïve résumé", {}, ["café", "naïve", "résumé"]),
    ("Café naïve résumé", {"ascii_fold": True}, ["cafe", "naive", "resume"]),
    ("Don’t stop", {}, ["don", "t", "stop"]),
    ("Don't stop", {"preserve_apostrophes": True}, ["don't", "stop"]),
    (
        "The quick brown fox jumps over the lazy dog",
        {"remove_stopwords": True},
        ["quick", "brown", "fox", "jumps", "over", "lazy", "dog"],
    ),
    ("a bb ccc", {"min_length": 2}, ["bb", "ccc"]),
]


@pytest.mark.parametrize("text,options,expected", GOLDEN)
def test_golden_tokens(spark, text, options, expected):
    assert cut(spark, text, **options) == expected


def test_golden_normalized(spark):
    assert one(spark, "  Hello\n\tworld  ", normalize_text(F.col("text"))) == "hello world"


@pytest.mark.parametrize(
    "text,options,expected",
    [
        (None, {}, []),
        ("", {}, []),
        ("", {"preserve_apostrophes": True}, []),
        (" '' ", {"preserve_apostrophes": True}, []),
        ("aʼb", {}, ["a", "b"]),
        ("aʼb", {"preserve_apostrophes": True}, ["a'b"]),
        ("aʼb", {"mode": "simple"}, ["aʼb"]),
        ("été", {}, ["été"]),
        ("ét", {"mode": "simple"}, ["e", "t"]),
        ("''word''", {"preserve_apostrophes": True}, ["word'"]),
        ("rock 'n' roll", {"preserve_apostrophes": True}, ["rock", "n", "roll"]),
        ("rock''n", {"preserve_apostrophes": True}, ["rock'n"]),
        ("ΟΔΥΣΣΕΥΣ", {}, ["οδυσσευς"]),
        ("ﬁn", {"ascii_fold": True}, ["fin"]),
        ("Ab CD", {"lowercase": False}, ["Ab", "CD"]),
        ("\U0001d7ce\U0001d7cf x", {"min_length": 2}, ["\U0001d7ce\U0001d7cf"]),
        ("the cat", {"remove_stopwords": True, "stopwords": {"cat"}}, ["the"]),
        ("the cat", {"remove_stopwords": True, "stopwords": []}, ["the", "cat"]),
        ("the cat", {"stopwords": ["cat"]}, ["the", "cat"]),
        ("Über-Größe 12b", {"mode": "ascii"}, ["ber", "gr", "e", "12b"]),
        ("Kelvin", {"mode": "ascii"}, ["elvin"]),
        ("a a b a", {}, ["a", "a", "b", "a"]),
    ],
)
def test_tokens(spark, text, options, expected):
    assert cut(spark, text, **options) == expected


def test_options_are_checked():
    with pytest.raises(TypeError):
        TokenOptions(stopwords="the")
    with pytest.raises(ValueError):
        TokenOptions(mode="stemmed")
    assert len(DEFAULT_STOPWORDS) == 27


def test_numbers_are_read_as_text(spark):
    frame = spark.createDataFrame([(12,)], "text int")
    assert frame.select(tokenize(F.col("text")).alias("x")).first()["x"] == ["12"]


def test_stable_ranges_need_no_normalisation():
    second = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for point in range(0x110000):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    for first, last in NFC_STABLE_RANGES:
        for point in range(first, last + 1):
            character = chr(point)
            assert unicodedata.normalize("NFC", character) == character, hex(point)
            assert unicodedata.combining(character) == 0, hex(point)
            assert point not in second, hex(point)


def test_normalisation_of_every_character(spark):
    points = [p for p in range(0x20000) if not 0xD800 <= p < 0xE000]
    rows = [(f"e{chr(p)}́" if p % 2 else f"{chr(p)}",) for p in points]
    frame = spark.createDataFrame(rows, "text string").select(
        "text", nfc(F.col("text")).alias("nfc"), ascii_fold(F.col("text")).alias("fold")
    )
    marks = {chr(p): None for p in range(0x300, 0x370)}
    for row in frame.collect():
        assert row["nfc"] == unicodedata.normalize("NFC", row["text"])
        folded = unicodedata.normalize("NFKD", row["text"]).translate(str.maketrans(marks))
        assert row["fold"] == folded


def test_term_counts(spark):
    counts = one(spark, "b a b c b", term_counts(tokenize(F.col("text"))))
    assert [tuple(c) for c in counts] == [("a", 1), ("b", 3), ("c", 1)]
    assert one(spark, "", term_counts(tokenize(F.col("text")))) == []


def test_snippet_window(spark):
    text = "x" * 50 + " Needle " + "y" * 100
    terms = F.array(F.lit("nothing"), F.lit("needle"))
    got = one(spark, text, snippet(F.col("text"), terms))
    assert got == text[51 - 40 : 51 + 6 + 80]


@pytest.mark.parametrize(
    "text,terms,expected",
    [
        (None, ["a"], None),
        ("", ["a"], None),
        ("abc", [], None),
        ("abc", ["z"], None),
        ("a concatenation", ["cat"], "a concatenation"),
        ("Fox", ["fox", "fo"], "Fox"),
    ],
)
def test_snippet_edges(spark, text, terms, expected):
    words = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    assert one(spark, text, snippet(F.col("text"), words)) == expected


def test_snippet_ties_go_to_the_first_term(spark):
    text = "needles" + "y" * 200
    both = F.array(F.lit("need"), F.lit("needle"))
    assert len(one(spark, text, snippet(F.col("text"), both))) == 4 + 80


def test_external_id_keeps_long_numbers(spark):
    rows = spark.createDataFrame([(5,), (1234567890,)], "n long").select(external_id(F.col("n")))
    assert [r[0] for r in rows.collect()] == ["doc_00000005", "doc_1234567890"]
