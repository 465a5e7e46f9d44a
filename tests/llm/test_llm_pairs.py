"""Near duplicates, embeddings and benchmark passages against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import values

from threadloom.llm import decontaminate, lattice, simhash
from threadloom.llm.cells import forest
from threadloom.llm.components import components


def roots(count, linked):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(count):
        for j in linked(i):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


# --- components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(60)]
    df = spark.createDataFrame(edges + [(5, None), (7, 7)], "a long, b long")
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = roots(2100, lambda i: near.get(i, ()))
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {n: want[n] for n in near if near[n] - {n}}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- SimHash


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = np.array(simhash.covering_masks(radius), np.uint64)
    rng = np.random.default_rng(0)
    for _ in range(3000):
        bits = rng.choice(64, rng.integers(0, radius + 1), replace=False)
        difference = np.uint64(sum(1 << int(b) for b in bits))
        assert ((masks & difference) == 0).any()


def near_ids(docs, **options):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, **options).collect()}


def test_simhash_of_documents(table):
    docs = table("documents")
    rows = sorted((r.doc_id, by_hand(r.text)) for r in docs.collect())
    fps = np.array([f for _, f in rows], np.uint64)
    want = roots(len(rows), lambda i: np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3))
    got = near_ids(docs)
    assert got == {i: (f"{f:016x}", rows[w][0]) for (i, f), w in zip(rows, want)}
    kept = [r.doc_id for r in simhash.keep_first(docs).collect()]
    assert sorted(kept) == sorted(i for i, (_, c) in got.items() if i == c)


def test_simhash_dense_groups(spark):
    rng = np.random.default_rng(1)
    centre = 0x123456789ABCDEF
    fps = np.unique(np.array([centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(900)], np.uint64))
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    ordered = np.sort(fps.view(np.int64)).view(np.uint64)
    want = roots(len(ordered), lambda i: np.flatnonzero(np.bitwise_count(ordered ^ ordered[i]) <= 3))
    signed = ordered.view(np.int64)
    for block in (16, 2048):
        got = {r.node: r.root for r in components(simhash.links(df, block=block)).collect()}
        assert [got.get(int(s), int(s)) for s in signed] == [int(signed[w]) for w in want]


def test_simhash_edges(spark):
    words = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n ", None), (9, words, "c"), (7, words.upper(), "d"), (8, "é" + words, "e"), (7, words, "d"), (None, words, "f"), (4, "x", "g"), (5, "word " * 200_000, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].fingerprint for i in (1, 2, 3)} == {"0" * 16} and {by[i].component_id for i in (1, 2, 3)} == {1}
    assert by[9].component_id == by[7].component_id == by[None].component_id == 7
    for doc_id, text, _ in rows:
        assert by[doc_id].fingerprint == f"{by_hand(text):016x}"
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in values(kept, "doc_id")].count(7) == 1 and kept.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(docs.where("false")).collect() == [] and simhash.keep_first(docs.where("false")).collect() == []


def test_forest_labels():
    near = {0: [1], 2: [3], 3: [1]}
    assert forest(5, lambda i: np.array(near.get(i, []), int)).tolist() == [0, 0, 0, 0, 4]


# --- embeddings


def linked_by_cosine(vectors, least=0.9):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    x = np.array([v if g else np.zeros(64) for v, g in zip(vectors, good)], float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    return near


def test_e8_is_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 8)) * 3
    point = lattice.nearest_e8(x)
    doubled = np.rint(2 * point).astype(int)
    assert (2 * point == doubled).all() and ((doubled % 2 == doubled[:, :1] % 2).all()) and (point.sum(1) % 2 == 0).all()
    own = ((x - point) ** 2).sum(1)
    others = ((x[:, None] - (point[:, None] + lattice.NEIGHBOURS[None])) ** 2).sum(2)
    assert len(lattice.NEIGHBOURS) == 240 and (own[:, None] <= others + 1e-9).all()


@pytest.mark.parametrize("block", [64, 1024])
def test_vectors(spark, block):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=64)
    vectors = [centre + rng.normal(size=64) * 0.1 for _ in range(200)] + [centre] * 20 + [rng.normal(size=64) for _ in range(150)]
    for _ in range(250):  # pairs from the threshold on
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        z = rng.normal(size=64)
        z -= z @ a * a
        z /= np.linalg.norm(z)
        cosine = rng.uniform(0.9, 0.95)
        vectors += [a, 5 * (cosine * a + np.sqrt(1 - cosine**2) * z)]
    vectors = [list(map(float, v)) for v in vectors] + [None, [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [], [float("inf")] * 64]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, kept int")
    got = {r.vec_id: r for r in lattice.near_vectors(df, block=block).collect()}
    near = linked_by_cosine(vectors)
    links = np.array([got[i].n_links for i in range(len(vectors))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.95 * near.sum()
    # The dense group and its copies are found whole, each pair once.
    assert links[:220].tolist() == near[:220].sum(1).tolist()
    assert all(got[i].component_id == 0 for i in range(220))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(len(vectors) - 6, len(vectors)))
    want = roots(len(vectors), lambda i: np.flatnonzero(near[i]))
    assert sum(got[i].component_id == w for i, w in enumerate(want)) >= 0.98 * len(want)


def test_vectors_of_the_table(table):
    rows = sorted((r.vec_id, r.embedding) for r in table("embeddings").collect())
    near = linked_by_cosine([v for _, v in rows])
    got = {r.vec_id: r.n_links for r in lattice.near_vectors(table("embeddings")).collect()}
    assert [got[i] for i, _ in rows] == near.sum(1).tolist()


def test_vector_edges(spark):
    one, other = [1.0, 0.0], [1.0, 0.0, 0.0]
    rows = [(3, one), (3, one), (None, one), (5, other), (None, None), (6, [2.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in lattice.near_vectors(df).collect())
    assert got == [("3", 3, "3", True), ("3", 3, "3", True), ("5", 0, "5", True), ("6", 3, "3", False), ("None", 0, "None", True), ("None", 3, "3", False)]
    assert lattice.near_vectors(df.where("false")).collect() == []


# --- benchmark passages


def squeeze(text):
    return re.sub(r"\s+", " ", text.lower()).strip()


def edit(text, count, rng):
    out = list(text)
    for _ in range(count):
        at, kind = rng.randrange(len(out)), rng.choice("sid")
        if kind == "s":
            out[at] = "#"
        elif kind == "i":
            out.insert(at, "@")
        else:
            del out[at]
    return "".join(out)


def test_planted_passages(spark, table):
    rng = random.Random(0)
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    prose = [r.text for r in table("documents").collect()]
    limits = decontaminate.Limits()
    searcher = decontaminate.Searcher(decontaminate.ItemIndex(items, limits), limits)
    for trial in range(150):
        item, text = rng.choice(items)
        passage = squeeze(text)
        if trial % 3 == 0 and len(passage) > 120:
            at = rng.randint(0, len(passage) - 110)
            passage = edit(passage[at : at + 110], 6, rng)
        else:
            passage = edit(passage, int(0.06 * len(passage)), rng)
        text = rng.choice(prose)[:600] + " " + passage + " " + rng.choice(prose)[:300]
        assert item in {hit[0] for hit in searcher.search(text)}


def test_passages_of_documents(table):
    docs, items = table("documents"), table("benchmark")
    normal = {r.item_id: squeeze(r.text) for r in items.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {(d, i) for d, t in texts.items() for i, n in normal.items() if n in squeeze(t)}
    found = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.edits == 0 and r.item_end - r.item_start == len(normal[r.item_id])} == want
    for r in found:
        if r.edits == 0:
            assert squeeze(texts[r.doc_id][r.start : r.end]) == normal[r.item_id][r.item_start : r.item_end].strip()
    assert want
    dropped = set(texts) - {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert dropped == {r.doc_id for r in found}


def test_blocks_find_the_same(table):
    docs, items = table("documents"), table("benchmark")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert whole == {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items, block_chars=9_000).collect()}


def test_banded_alignment():
    def full(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [row[0] + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = random.Random(5)
    for _ in range(60):
        a = [rng.randint(0, 3) for _ in range(rng.randint(5, 25))]
        b = [rng.randint(0, 3) for _ in range(5)] + a[:]
        for _ in range(2):
            b[rng.randrange(len(b))] = 9
        width = 12
        region = np.array(b + [-1] * (len(a) + width + 1 - len(b)))[: len(a) + width + 1]
        got, _ = decontaminate.banded(np.array([a]), region[None], width)
        assert got[0] == full(a, b[: len(a) + width])


def least_edits(pattern, text):
    """Edits of the pattern against its best place in the text."""
    row = [0] * (len(text) + 1)
    for x in pattern:
        new = [row[0] + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def between(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(6))
def test_against_exhaustive_alignment(seed):
    """Every passage of the certain length within its edits is found, and nothing else."""
    rng = random.Random(seed)
    letters = "ab-" if seed % 2 else "abcdefgh "
    some = lambda n: "".join(rng.choice(letters) for _ in range(n)) if seed % 3 else "-" * (n // 2) + "".join(rng.choice(letters) for _ in range(n - n // 2))
    limits = decontaminate.Limits(q=5, error=0.1, least=30, fuzzy=12, shortest=4, q2=3)
    items = [(i, squeeze(some(rng.choice([34, 40, 25, 60])))) for i in range(8)]
    items = [(i, t) for i, t in items if len(t) >= 12]
    searcher = decontaminate.Searcher(decontaminate.ItemIndex(items, limits), limits)
    searcher.MOST_HITS = rng.choice([40, 4_000_000])
    for _ in range(12):
        text = some(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            _, item = rng.choice(items)
            at = rng.randint(0, max(0, len(item) - 30))
            text += edit(item[at : at + 30], rng.randint(0, 5), rng) + some(rng.randint(0, 20))
        clean = squeeze(text + "x")[:-1]
        found = {hit[0]: hit for hit in searcher.search(text)}
        for i, item in items:
            size = min(len(item), limits.least)
            edits = int(limits.edits(size))
            best = min(least_edits(item[k : k + size], clean) for k in range(len(item) - size + 1))
            if best <= edits:
                assert i in found, (item, clean)
            if i in found:
                _, start, end, first, last, cost = found[i]
                assert last - first >= size and cost <= limits.edits(last - first)
                assert between(item[first:last], squeeze("x" + text[start:end] + "x")[1:-1]) <= cost


def test_repeated_characters_end():
    """Long lines of one character on both sides; runs of hits that pause for longer than an item."""
    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    limits = decontaminate.Limits()
    few = decontaminate.Searcher(decontaminate.ItemIndex([(i, words(20) + "\n" + "-" * 60 + "\n" + words(20)) for i in range(60)], limits), limits)
    assert few.search("\n".join(["-" * 60] * 50)) == []
    many = decontaminate.Searcher(decontaminate.ItemIndex([(i, words(20) + "\n" + "-" * 200 + "\n" + words(20)) for i in range(120)], limits), limits)
    many.MOST_HITS = 5_000
    assert len(many.search("-" * 200 + words(3000) + "\n" + "-" * 200)) == 120


def test_short_items_and_items_without_an_id(spark):
    items = spark.createDataFrame([(1, "What is the capital city of France?"), (None, " The  Answer is\nforty-two "), (None, None), (4, "Paris"), (5, "forty-two apples and forty-two pears")], "item_id long, text string")
    rows = [(1, "Q: what is the Capital\ncity of FRANCE? Paris."), (2, "the answer is forty-two, the answer is forty-two"), (3, "the answer is forty-twos"), (4, "xwhat is the capital city of france?"), (5, "forty-two apples and forty-two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(p)[:3] for p in r.passages] for r in decontaminate.find_passages(docs, items).collect()}
    assert got == {1: [(1, 3, 38)], 2: [(None, 0, 23)], 3: [], 4: [], 5: []}
    all_lengths = decontaminate.Limits(shortest=1)
    assert {r.item_id for r in decontaminate.leaks(docs, items, limits=all_lengths).collect()} == {1, 4, None}


def test_passage_edges(spark):
    passage = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of mandrake root tonight"
    items = spark.createDataFrame([(1, passage, 0), (2, None, 0), (3, "short", 0), (4, "", 0), (1, passage, 0)], "item_id long, text string, start int")
    rows = [(1, passage.upper().replace(" ", "\n\t"), "x"), (2, None, "x"), (3, "", "x"), (4, "short", "x"), (None, passage, "x"), (5, "b " * 300_000 + passage, "x"), (5, "a" * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, passages string")
    got = decontaminate.find_passages(docs, items).collect()
    assert len(got) == len(rows)
    assert sorted(str(r.doc_id) for r in got if r.passages) == ["1", "5", "None"]
    hit = next(r for r in got if r.doc_id == 5 and r.passages).passages[0]
    assert (hit.start, hit.end, hit.edits) == (600_000, 600_000 + len(passage), 0)
    assert decontaminate.leaks(docs.where("false"), items).collect() == [] and decontaminate.leaks(docs, items.where("false")).collect() == []
    assert decontaminate.drop_contaminated(docs, items).columns == docs.columns


def test_hubs_can_be_split(spark):
    """Both sides of the stars' joins come straight out of shuffles, which adaptive execution needs to split a hub."""
    from threadloom.llm.components import _large, _small

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(100).selectExpr("id + 1 AS a", "id % 10 AS b").where("a > b").repartition(3)
        for star in (_large, _small):
            assert "Exchange hashpartitioning(u#" in star(edges)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
