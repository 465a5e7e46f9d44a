import re

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as X
from threadloom.functions.stemming import porter, stem_tokens
from threadloom.functions.stopwords import ENGLISH, stopwords
from threadloom.functions.text import TextOptions, clean, tokens

OFF = dict(remove_urls=False, remove_special_chars=False, remove_stopwords=False, lowercase=False)


def cleaned(frame, text, **options):
    df = frame([(text,)], "t string")
    return df.select(clean(F.col("t"), TextOptions(**options))).first()[0]


@pytest.mark.parametrize(
    "text,expected,options",
    [
        (None, "", {}),
        ("", "", {}),
        ("see https://x.y/z now", "see", {}),  # 'now' is a stopword
        ("see https://x.y/z now", "see now", {"remove_stopwords": False}),
        ("HTTP://X.Y now", "httpxy", {}),
        ("abwwwcd ef", "ab ef", {"remove_stopwords": False}),
        ("www http", "www http", {"remove_stopwords": False}),
        ("naïve_été, 50%!", "naïve_été 50", {"remove_stopwords": False}),
        ("a1b2 ٣", "ab", {"remove_numbers": True, "remove_stopwords": False}),
        ("The the", "The", {"lowercase": False}),
        ("don't stop", "dont stop", {}),
        ("I cannot Gonna go", "I can not Gon na go", {"remove_stopwords": False, "lowercase": False}),
        ("I cannot go", "go", {}),
        ("_cannot_ cannotx", "_cannot_ cannotx", {}),
        ("  a\t\n b  ", "a b", OFF),
        ("a, b", "a, b", OFF),
        ("x² ¼ y", "x² ¼ y", {"remove_stopwords": False}),
    ],
)
def test_chain(frame, text, expected, options):
    assert cleaned(frame, text, **options) == expected


def test_url_before_lowercase_and_no_second_pass(frame):
    once = cleaned(frame, "ht.tp://x wW.w", remove_stopwords=False)
    assert once == "httpx www"


def test_tokens(frame):
    df = frame([("The cat, the hat",), (None,)], "t string")
    assert [r[0] for r in df.select(tokens(F.col("t"))).collect()] == [["cat", "hat"], []]


def test_character_classes_match_unicode_regex(spark):
    """Space and digit classes equal Python's on every character of two planes."""
    points = [c for c in range(0x1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "cp int, ch string")
    found = df.select(
        "cp",
        F.col("ch").rlike(f"^[{X.SPACE}]$").alias("space"),
        F.col("ch").rlike(f"^[{X.DIGIT}]$").alias("digit"),
        F.col("ch").rlike(f"^[{X.WORD}]$").alias("word"),
    ).toPandas()
    python = {c: chr(c) for c in points}
    space = {c for c, ch in python.items() if re.match(r"\s", ch)}
    word = {c for c, ch in python.items() if re.match(r"\w", ch)}
    digit = {c for c, ch in python.items() if re.match(r"\d", ch)}
    assert set(found.cp[found.space]) == space
    assert set(found.cp[found.digit]) <= digit
    assert set(found.cp[found.word]) <= word


def test_stopword_lists(spark):
    assert len(ENGLISH) == len(set(ENGLISH)) == 179
    assert "der" in stopwords("german")
    with pytest.raises(Exception):
        stopwords("klingon")


def test_custom_stopwords(frame):
    assert cleaned(frame, "one two three", stopword_list=("two",)) == "one three"


@pytest.mark.parametrize(
    "word,stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("caress", "caress"),
        ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"),
        ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
        ("troubled", "troubl"), ("sized", "size"), ("hopping", "hop"), ("tanned", "tan"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
        ("conditional", "condit"), ("rational", "ration"), ("valenci", "valenc"),
        ("digitizer", "digit"), ("operator", "oper"), ("feudalism", "feudal"),
        ("decisiveness", "decis"), ("hopefulness", "hope"), ("formaliti", "formal"),
        ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("formative", "form"),
        ("formalize", "formal"), ("electriciti", "electr"), ("electrical", "electr"),
        ("hopeful", "hope"), ("goodness", "good"), ("revival", "reviv"),
        ("allowance", "allow"), ("inference", "infer"), ("airliner", "airlin"),
        ("adjustable", "adjust"), ("defensible", "defens"), ("irritant", "irrit"),
        ("replacement", "replac"), ("adjustment", "adjust"), ("dependent", "depend"),
        ("adoption", "adopt"), ("communism", "commun"), ("activate", "activ"),
        ("effective", "effect"), ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"),
        ("controll", "control"), ("roll", "roll"), ("dying", "die"), ("died", "die"),
        ("Running", "run"), ("it", "it"), ("y", "y"), ("", ""), ("été", "été"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def test_stem_tokens_keeps_rows_and_nulls(frame):
    df = frame([(1, ["cats", "running", "cats"]), (2, []), (3, None), (4, ["ponies"])], "i int, w array<string>")
    got = {r[0]: r[1] for r in df.select("i", stem_tokens("w")).collect()}
    assert got == {1: ["cat", "run", "cat"], 2: [], 3: None, 4: ["poni"]}


def test_stemming_option(frame):
    assert cleaned(frame, "The cats were running", stemming=True) == "cat run"
