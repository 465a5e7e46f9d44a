"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from threadloom.llm import variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def by_hand(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= 2 * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts)


def rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def drawn(seed, count=900):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(2, 9))) for _ in range(count)]
    counts = {w: rng.randint(1, 50) for w in words}
    counts |= {"a": 4, "b": 9, "ab": 60, "a" * 2000: 7, "a" * 1999 + "b": 3, "a" * 2001: 20}
    return counts


@pytest.mark.parametrize("block", [2048, 24])
def test_groups(spark, block):
    counts = drawn(block)
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(variants.group_variants(vocabulary, block=block)) == by_hand(counts)


def test_a_long_way_to_the_root(spark):
    counts = {"a" * k + "b" * (12 - k): 3 * 2**k for k in range(13)}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows(variants.group_variants(vocabulary))
    assert got == by_hand(counts) and {r[2] for r in got} == {"a" * 12}


def test_words_of_texts(spark):
    rng = random.Random(5)
    words = ["Straße", "straße", "naïve", "NAIVE", "colour", "color", "it", "ÀÉ÷×ab", "über", "letters"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))) + "-x9" * (i % 3)) for i in range(200)]
    docs += [(None, "naive naive colour"), (7, None), (8, ""), (3, docs[3][1]), (9, "colour " * 5000)]
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string")
    assert {r.word: r.n for r in variants.word_counts(frame).collect()} == counts
    assert rows(variants.spelling_variants(frame)) == by_hand(counts)
    assert any(counts[w] for w in counts if w not in {x.lower() for x in words} | set(words))


def test_edges(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert variants.group_variants(none).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    given = spark.createDataFrame([("words", 2, 1), ("words", 3, 2), (None, 9, 3), ("wards", 1, 4)], "word string, n long, root int")
    assert rows(variants.group_variants(given)) == [("wards", "words", "words", 1, 1, 5), ("words", None, "words", 5, 1, None)]


def test_counts_add_up_over_rows(spark):
    docs = spark.createDataFrame([(i, "seven eight") for i in range(50)], "doc_id long, text string")
    counts = {r.word: r.n for r in variants.word_counts(docs, slip_every=None).collect()}
    assert counts == {"seven": 50, "eight": 50}
