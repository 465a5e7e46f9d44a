"""Mixing against a plain queue simulation."""

import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from threadloom.llm import mixing

DOCS = "doc_id long, text string, source string"


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(sizes):
    """Shares by weight, the excess of full sources shared anew until none is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full)
        share = {s: Fraction(rest * weight[s], shared) if s not in full else Fraction(3 * sizes[s]) for s in names}
        above = {s for s in names if share[s] > 3 * sizes[s]}
        if not above:
            return share
        full |= above


def by_hand(docs):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    target = targets_by_hand(sizes)
    key = lambda d: hashlib.md5(f"mix:{'' if d[0] is None else d[0]}:{d[1] or ''}".encode()).hexdigest()
    line = []
    for source in sizes:
        queue = sorted((i for i, d in enumerate(docs) if d[2] == source), key=lambda i: (key(docs[i]), docs[i][0] if docs[i][0] is not None else -1))
        end = 0
        for n in range(3):
            for i in queue:
                if size := size_of(docs[i][1]):
                    end += size
                    line.append((end / target[source], source is None, source or "", n, i, size))
    taken, total = [0] * len(docs), 0
    for *_, i, size in sorted(line):
        total += size
        if total > sum(sizes.values()):
            break
        taken[i] += size
    out = [(d[0], size_of(d[1]), sizes[d[2]], float(target[d[2]]), t) for d, t in zip(docs, taken)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in df.collect()), key=repr)


def drawn(seed, sources, count=400):
    rng = random.Random(seed)
    pick = lambda: sources[0] if rng.random() < 0.4 else rng.choice(sources)
    return [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 3, 10, 40]))), pick()) for i in range(count)]


@pytest.mark.parametrize("sources", [["a", "b", "c", None], ["é", "z", "Z", "", None], [f"s{i}" for i in range(40)], ["only"], [None]])
def test_mix(spark, sources):
    docs = drawn(len(sources), sources)
    got = rows(mixing.mix(spark.createDataFrame(docs, DOCS)))
    want = by_hand(docs)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_laws(spark):
    docs = spark.createDataFrame(drawn(3, ["a", "b", "c", "d", None], 1500), DOCS)
    mixed = mixing.mix(docs).cache()
    totals = mixed.agg(F.sum("size"), F.sum("taken")).first()
    assert totals[0] - 40 <= totals[1] <= totals[0]
    assert mixed.where("taken > 3 * size or taken % greatest(size, 1) <> 0").isEmpty()
    joined = docs.join(mixed.select("doc_id", "size", "target", "taken"), "doc_id").groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"))
    for row in joined.collect():
        assert abs(row.n - row.t) <= 40 + 0.02 * row.t


def test_input_order_and_partitions_do_not_matter(spark):
    docs = spark.createDataFrame(drawn(9, ["a", "b", None]), DOCS)
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs.repartition(7, "text").orderBy(F.desc("text"))))


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    nothing = [(1, None, "a"), (2, "", None), (None, " \t", "a")]
    assert rows(mixing.mix(spark.createDataFrame(nothing, DOCS))) == sorted(((d[0], 0, 0, 0.0, 0) for d in nothing), key=repr)
    repeated = [(1, "one two", "a")] * 3 + [(None, "x " * 5000, "b"), (None, None, "b"), (5, "y", "c")]
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in repeated], DOCS + ", size int, taken int, target int")
    assert rows(mixing.mix(frame)) == by_hand(repeated)
    assert not any(re.search("Python|Arrow|Pandas", line) for line in mixing.mix(frame)._jdf.queryExecution().toString().splitlines())
