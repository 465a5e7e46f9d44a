"""Random texts against an independent, character-by-character statement of the chain."""

import itertools

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from threadloom.functions.stopwords import ENGLISH
from threadloom.functions.text import CONTRACTIONS, TextOptions, clean

PIECES = [
    "http", "www", "https://a.b/c", "HTTP", "The", "the", "cannot", "Gonna", "don't", "naïve", "été", "ΣΑΣ",
    "straße", "Ж", "٣٤", "12", "²", "_", "-", "'", '"', ".", ",", "…", "—", "€", "😀", "é",
    " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x1c", "\x85", "\x0b", "\x00", "a", "Z", "中文",
]
TEXT = st.lists(st.sampled_from(PIECES), max_size=25).map("".join)
FLAGS = [
    dict(zip(("remove_urls", "lowercase", "remove_special_chars", "remove_numbers", "remove_stopwords"), on))
    for on in itertools.product((True, False), repeat=5)
]


def without_urls(text):
    kept, i = [], 0
    while i < len(text):
        end = next((i + len(h) for h in ("http", "www") if text.startswith(h, i)), None)
        if end is not None and end < len(text) and not text[end].isspace():
            while end < len(text) and not text[end].isspace():
                end += 1
            i = end
        else:
            kept.append(text[i])
            i += 1
    return "".join(kept)


def split_word(word):
    """Contractions count as whole words between characters that are not word characters."""
    runs = ["".join(g) for _, g in itertools.groupby(word, lambda c: c.isalnum() or c == "_")]
    shown = []
    for run in runs:
        if run.lower() in CONTRACTIONS:
            head = len(CONTRACTIONS[run.lower()][0])
            run = run[:head] + " " + run[head:]
        shown.append(run)
    return "".join(shown).split(" ")


def expected(text, flags):
    if flags["remove_urls"]:
        text = without_urls(text)
    if flags["lowercase"]:
        text = text.lower()
    if flags["remove_special_chars"]:
        text = "".join(c for c in text if c.isalnum() or c == "_" or c.isspace())
    if flags["remove_numbers"]:
        text = "".join(c for c in text if not c.isdecimal())
    words = [w for piece in text.split() for w in split_word(piece)]
    if flags["remove_stopwords"]:
        words = [w for w in words if w not in ENGLISH]
    return " ".join(words)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=20, max_size=60))
def test_chain_against_characters(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    columns = [clean(F.col("t"), TextOptions(**flags)).alias(f"c{n}") for n, flags in enumerate(FLAGS)]
    for row in df.select("t", *columns).collect():
        for n, flags in enumerate(FLAGS):
            assert row[f"c{n}"] == expected(row.t, flags), (row.t, flags)
