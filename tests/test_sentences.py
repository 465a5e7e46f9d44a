"""Sentence borders and punctuation tokens by hand."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from threadloom.functions.sentences import SentenceModel, fit_sentences, sentence_tokens, sentences
from threadloom.functions.text import TextOptions, clean, tokens

PROSE = (
    ["Mr. Smith met Dr. Jones at noon.", "The road was long. The day was hot.", "He saw Mr. Brown and the dog.", "the cat sat on the mat."] * 6
    + ["We met at 5 p.m. The dog slept.", "It was 5 p.m. and dark.", "They left at 6 p.m. and slept.", "the mat is hot at noon and a dog or cat slept long"] * 4
)


@pytest.fixture(scope="module")
def model(spark):
    return fit_sentences(spark.createDataFrame([(t,) for t in PROSE], "text string"), "text")


def of(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column).first()[0]


def test_learnt(model):
    assert {"mr", "dr", "p.m"} <= set(model.abbreviations) and not {"noon", "dog", "mat"} & set(model.abbreviations)
    assert "the" in model.starters and "smith" not in model.starters


@pytest.mark.parametrize(
    "text, want",
    [
        ("Mr. Smith slept. The dog sat at 5 p.m. The cat ran.", ["Mr. Smith slept.", "The dog sat at 5 p.m.", "The cat ran."]),
        ("It was 5 p.m. and dark.  Was it? Yes! \"So.\" he said", ["It was 5 p.m. and dark.", "Was it?", "Yes!", '"So."', "he said"]),
        ("J. S. Bach wrote... and slept... Then no. 5 came. 3. may", ["J. S. Bach wrote... and slept...", "Then no.", "5 came.", "3. may"]),
        ("", []),
        (None, []),
        (" \n\t", []),
        ("one", ["one"]),
    ],
)
def test_borders(spark, model, text, want):
    assert of(spark, text, sentences(F.col("text"), model)) == want


def test_texts_without_full_stops_teach_nothing(spark):
    assert fit_sentences(spark.createDataFrame([("no stops here",), (None,), ("",)], "text string"), "text") == SentenceModel()
    assert fit_sentences(spark.createDataFrame([], "text string"), "text") == SentenceModel()
    only = spark.createDataFrame([("a. b. c.",)], "text string")
    assert of(spark, "a. b.", sentences(F.col("text"), fit_sentences(only, "text"))) == ["a. b."]
    with pytest.raises(ValueError):
        fit_sentences(spark.createDataFrame([(t,) for t in PROSE], "text string"), "text", most=1)


@pytest.mark.parametrize(
    "text, want",
    [
        ('He said, "It\'s 3,000 (or so)."', ["He", "said", ",", "``", "It", "'s", "3,000", "(", "or", "so", ")", ".", "''"]),
        ("Don't stop; we'll see... the dogs' home -- yes!", ["Do", "n't", "stop", ";", "we", "'ll", "see", "...", "the", "dogs", "'", "home", "--", "yes", "!"]),
        ("A 5% cut: $4.50 [a] a.b", ["A", "5", "%", "cut", ":", "$", "4.50", "[", "a", "]", "a.b"]),
        (None, []),
    ],
)
def test_punctuation(spark, text, want):
    assert of(spark, text, sentence_tokens(F.col("text"))) == want


def test_in_the_chain(spark, model):
    on = TextOptions(remove_special_chars=False, punctuation_tokens=True, remove_stopwords=False, lowercase=False, sentence_model=model)
    text = "I cannot go. Mr. Smith can, he says."
    want = ["I", "can", "not", "go", ".", "Mr.", "Smith", "can", ",", "he", "says", "."]
    assert of(spark, text, tokens(F.col("text"), on)) == want
    assert of(spark, text, clean(F.col("text"), on)) == " ".join(want)
    assert of(spark, text, tokens(F.col("text"), dataclasses.replace(on, remove_special_chars=True))) == "I can not go Mr Smith can he says".split()


def test_words_are_counted_in_batches(spark):
    from threadloom.functions.sentences import word_statistics, words

    texts = ["A b c.\x85D e.  (F.) g\x1ch　i", None, "", " \n", 'He said "No." Then J. K. left', "b b B"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = {r.type: tuple(r)[1:] for r in word_statistics(df, "text").collect()}
    assert sum(s + p for s, p, _, _ in got.values()) == sum(len(r[0]) for r in df.select(words(F.col("text"))).collect())
    assert got["b"] == (0, 4, 3, 1) and got["c"] == (1, 0, 1, 0) and got["d"] == (0, 1, 0, 0)
    assert got["no"] == (1, 0, 0, 1) and got["then"] == (0, 1, 0, 0) and got["k"] == (1, 0, 0, 0)
    plan = word_statistics(df, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
