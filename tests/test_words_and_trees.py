"""Morphology, keyword automata and subtree measures against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.keywords import KeywordAutomaton, holds_keyword, keyword_hits
from threadloom.operators.morphology import lemma_table
from threadloom.operators.tour import is_above, subtree_measures
from threadloom.operators.tree import walk
from threadloom.operators.vocab import lemmatize


# --- lemmas


def lemmas(spark, words, known, part="noun", exceptions=None):
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    odd = None if exceptions is None else frame(exceptions, "word string, lemma string")
    table = lemma_table(frame([(w,) for w in words], "word string"), frame([(w,) for w in known], "word string"), part, odd)
    return {r.word: r.lemma for r in table.collect()}


def test_endings_and_exceptions(spark):
    known = ["dog", "bus", "fox", "church", "woman", "city", "wolf", "as", "glass", None]
    words = ["dogs", "buses", "foxes", "churches", "women", "cities", "wolves", "as", "glasses", "mice", "blorgs", "dog", None, "s", "dogs"]
    got = lemmas(spark, words, known, exceptions=[("mice", "mouse"), ("dogs", "hound"), ("dogs", "cur"), ("absent", "x"), ("as", None)])
    assert got == {
        "dogs": "cur", "buses": "bus", "foxes": "fox", "churches": "church", "women": "woman", "cities": "city", "wolves": "wolf",
        "as": "as", "glasses": "glass", "mice": "mouse", "blorgs": "blorgs", "dog": "dog", "s": "s",
    }


def test_kinds_of_words(spark):
    assert lemmas(spark, ["hoping", "hopped", "hopes", "tries"], ["hope", "try"], "verb") == {"hoping": "hope", "hopped": "hopped", "hopes": "hope", "tries": "try"}
    assert lemmas(spark, ["hoping"], ["hope", "hop"], "verb") == {"hoping": "hop"}  # the shortest known form
    assert lemmas(spark, ["larger", "tallest"], ["large", "tall"], "adjective") == {"larger": "large", "tallest": "tall"}
    assert lemmas(spark, [], ["x"]) == {} and lemmas(spark, ["x"], []) == {"x": "x"}
    with pytest.raises(ValueError):
        lemmas(spark, ["x"], ["x"], "adverb")


def test_a_text_by_its_table(spark):
    texts = spark.createDataFrame([("the dogs saw foxes",), (None,)], "text string")
    words = texts.select(F.explode(F.split("text", " ")).alias("word"))
    table = lemma_table(words, spark.createDataFrame([("dog",), ("fox",)], "word string"))
    assert sorted(r.text or "" for r in lemmatize(texts, "text", table).collect()) == ["", "the dog saw fox"]


# --- keywords


@pytest.mark.parametrize("seed", range(5))
def test_automaton(seed):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    keywords = [some(rng.randint(1, 6)) for _ in range(80)]
    automaton = KeywordAutomaton(keywords)
    for _ in range(60):
        text = some(rng.randint(0, 50))
        want = [i for i, k in enumerate(automaton.keywords) if k in text]
        assert automaton.found(text) == want and automaton.any(text) == bool(want)


def test_keywords_of_rows(spark):
    rows = [(1, "Deep LEARNING models", "x"), (2, "a.b", "x"), (3, None, "x"), (4, "", "x"), (5, "é" * 100_000 + "model", "x"), (1, "Deep LEARNING models", "x")]
    df = spark.createDataFrame(rows, "id int, title string, keywords string")
    got = sorted((r.id, r.keywords) for r in keyword_hits(df, ["model", "deep learning", "els", "model", "a.b", "axb"]).collect())
    first = (1, ["model", "deep learning", "els"])
    assert got == [first, first, (2, ["a.b"]), (3, []), (4, []), (5, ["model"])]
    assert sorted(r.id for r in holds_keyword(df, ["models", "a.b"]).collect()) == [1, 1, 2]
    assert holds_keyword(df, []).isEmpty() and holds_keyword(df, [""]).count() == 5


# --- subtrees


def by_hand(rows):
    """(size, score, ancestors) per comment of rows (post, id, parent, score)."""
    parent = {(p, i): (p, up) for p, i, up, _ in rows}
    score = {(p, i): s or 0 for p, i, _, s in rows}
    size, total, above = dict.fromkeys(parent, 0), dict.fromkeys(parent, 0), set()
    for node in parent:
        at = node
        while at in parent:
            size[at] += 1
            total[at] += score[node]
            if at != node:
                above.add((at, node))
            at = parent[at]
    return size, total, above


def test_subtrees(spark):
    rng = random.Random(2)
    rows = []
    for p in range(4):
        for i in range(60 if p else 1):
            rows.append((f"p{p}", f"c{i}", f"c{rng.randrange(i)}" if i and rng.random() < 0.8 else f"p{p}", rng.choice([None, -3, 5])))
    lost = [("p1", "x", "gone", 1), ("p1", "y", "z", 1), ("p1", "z", "y", 1), (None, "n", "p1", 1)]
    df = spark.createDataFrame(rows + lost, "post_id string, id string, parent_id string, score int")
    got = subtree_measures(walk(df))
    size, total, above = by_hand(rows)
    found = {(r.post_id, r.id): r for r in got.collect()}
    assert {k: r.subtree_size for k, r in found.items()} == size and {k: r.subtree_score for k, r in found.items()} == total
    for post in {r[0] for r in rows}:
        steps = sorted(x for (p, _), r in found.items() if p == post for x in (r.enter, r.leave))
        assert steps == list(range(len(steps)))
    pairs = got.alias("a").join(got.alias("b"), is_above()).select("a.post_id", F.col("a.id").alias("up"), F.col("b.id").alias("down"))
    assert {((r.post_id, r.up), (r.post_id, r.down)) for r in pairs.collect()} == above


def test_a_very_deep_thread(spark):
    depth = 100_000
    chain = spark.range(depth).selectExpr("'p' AS post_id", "concat('c', id) AS id", "IF(id = 0, 'p', concat('c', id - 1)) AS parent_id", "1 AS score")
    got = subtree_measures(chain).where("id IN ('c0', 'c1', 'c50000', 'c99999')").collect()
    assert {r.id: (r.enter, r.leave, r.subtree_size, r.subtree_score) for r in got} == {
        f"c{i}": (i, 2 * depth - 1 - i, depth - i, depth - i) for i in (0, 1, 50_000, 99_999)
    }


def test_repeated_rows_and_nothing(spark):
    rows = [("p", "a", "p", 5), ("p", "a", "p", 2), ("p", "b", "a", 1)]
    df = spark.createDataFrame(rows, "post_id string, id string, parent_id string, score int")
    got = sorted((r.id, r.score, r.subtree_size, r.subtree_score) for r in subtree_measures(walk(df)).collect())
    assert got == [("a", 2, 2, 3), ("a", 5, 2, 3), ("b", 1, 1, 1)]
    assert subtree_measures(walk(df.where("false"))).collect() == []
