import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from threadloom.operators import relate, sets
from threadloom.operators.features import comment_features, post_features, top_values
from threadloom.operators.rank import (
    COMMENT_ORDERS,
    POST_ORDERS,
    RANK,
    comment_listing,
    first_per_group,
    listing,
)
from threadloom.operators.search import search
from threadloom.operators.tree import roots, walk
from threadloom.plans.collect import posts_with_comments
from threadloom.plans.prepare import extract_features, prepare_for_ml

POSTS = "id string, title string"
CHILDREN = "id string, post_id string, score int"


@pytest.fixture
def posts(frame):
    return frame([("p1", "one"), ("p2", "two"), ("p3", "three")], POSTS)


@pytest.fixture
def children(frame):
    return frame([("c1", "p1", 5), ("c2", "p1", 7), ("c3", "p2", 1), ("c4", "zz", 2)], CHILDREN)


def test_with_children(posts, children):
    inner = relate.with_children(posts, children)
    assert values(inner, "id", "comment_id") == [("p1", "c1"), ("p1", "c2"), ("p2", "c3")]
    left = relate.with_children(posts, children, how="left")
    assert ("p3", None) in values(left, "id", "comment_id")
    with pytest.raises(ValueError):
        relate.with_children(posts, children, how="cross")


def test_with_parent(posts, children):
    got = relate.with_parent(children, posts)
    assert values(got, "id", "title") == [("c1", "one"), ("c2", "one"), ("c3", "two"), ("c4", None)]


def test_lookups(posts, children):
    assert values(relate.orphans(children, posts), "id") == [("c4",)]
    assert relate.known(posts, posts).count() == 3
    assert relate.unknown(posts, posts).count() == 0
    assert values(relate.child_counts(posts, children), "id", "comment_count") == [
        ("p1", 2), ("p2", 1), ("p3", 0),
    ]


def test_collections(posts, children):
    got = relate.collections(posts, children, ["id", "score"])
    assert values(got, "id", "chunk", "comments") == [
        ("p1", 0, [("c1", 5), ("c2", 7)]), ("p2", 0, [("c3", 1)]), ("p3", 0, []),
    ]


def test_collections_split_hot_parents(spark):
    kids = spark.range(1000).select(F.col("id"), F.lit("p").alias("post_id"))
    parent = spark.createDataFrame([("p",)], "id string")
    got = relate.collections(parent, kids, ["id"], chunk_size=100).collect()
    assert len(got) == 10
    assert all(r.comments == sorted(r.comments) and len(r.comments) < 200 for r in got)
    assert sorted(c.id for r in got for c in r.comments) == list(range(1000))


def test_unions(frame):
    a, b = frame([(1, "x")], "id int, s string"), frame([(2, 3)], "id int, n int")
    assert values(sets.concat(a, b), "id", "s", "n") == [(1, "x", None), (2, None, 3)]
    got = sets.corpus(("post", a, "id", "s"), ("comment", a.withColumn("s", F.lit(None).cast("string")), "id", "s"))
    assert values(got, "kind", "id", "text") == [("comment", "1", ""), ("post", "1", "x")]


# Features --------------------------------------------------------------------

FULL = "score int, num_comments int, is_self boolean, domain string, community string"


def test_post_features(frame):
    df = frame([(1, 2, True, "a", "x"), (4, 0, False, "b", "x"), (None, 1, None, None, "y")], FULL)
    row = post_features(df).first()
    assert (row.avg_score, row.max_score, row.avg_comments, row.total_posts) == (2.5, 4, 1.0, 3)
    assert row.self_post_ratio == 0.5
    assert [tuple(d) for d in row.top_domains] == [("a", 1), ("b", 1)]
    grouped = {r.community: r for r in post_features(df, ["community"]).collect()}
    assert grouped["x"].total_posts == 2 and grouped["y"].top_domains is None


def test_features_of_nothing(frame):
    row = post_features(frame([], FULL)).first()
    assert row.total_posts == 0 and row.avg_score is None and not row.top_domains
    lean = post_features(frame([(1, 2)], "score int, num_comments int")).first()
    assert lean.self_post_ratio is None and lean.top_domains is None
    comments = comment_features(frame([(1,), (2,)], "score int")).first()
    assert tuple(comments) == (1.5, 2, 2, None)


def test_top_values(frame):
    names = [f"d{i:02d}" for i in range(12)]
    rows = [(n, i % 2) for i, n in enumerate(names)] + [("d11", 0), (None, 0)]
    df = frame(rows, "v string, g int")
    got = [tuple(r) for r in top_values(df, "v").collect()]
    assert got == [("d11", 2)] + [(n, 1) for n in names[:9]]
    assert top_values(df, "v", 2, ["g"]).count() == 4


def test_extract_features(frame):
    p = frame([(1, 2, True, "a", "x")], FULL)
    c = frame([(3, 1), (5, 2)], "score int, depth int")
    row = extract_features(p, c).first()
    assert row.post_features.total_posts == 1 and row.post_features.top_domains[0].value == "a"
    assert tuple(row.comment_features) == (4.0, 5, 2, 1.5)


def test_prepare_for_ml(frame):
    p = frame([("1", None), ("2", "x")], "id string, selftext string")
    c = frame([("7", "y")], "id string, body string")
    got = prepare_for_ml(p, c)
    assert values(got.all_texts, "kind", "id", "text") == [
        ("comment", "7", "y"), ("post", "1", ""), ("post", "2", "x"),
    ]
    empty = prepare_for_ml(p.limit(0), c.limit(0))
    assert empty.all_texts.count() == 0


# Listings --------------------------------------------------------------------

AS_OF = dt.datetime(2024, 1, 10)


@pytest.fixture
def ranked(spark):
    rows = [
        ("a", 10, 0.9, "2024-01-09 00:00:00", 3),
        ("b", 100, 0.6, "2024-01-01 00:00:00", 9),
        ("c", 10, 0.5, "2024-01-08 00:00:00", 1),
        ("d", -5, 0.2, "2024-01-09 23:00:00", 0),
        ("e", 1, 1.0, "2023-01-01 00:00:00", 0),
    ]
    df = spark.createDataFrame(rows, "id string, score int, upvote_ratio double, t string, num_comments int")
    return df.select("*", F.col("t").cast("timestamp").alias("created_utc"))


def ids(df):
    return [r.id for r in df.collect()]


def test_listing_orders(ranked):
    pick = lambda how, **kw: ids(listing(ranked, how, as_of=AS_OF, **kw))
    assert pick("new") == ["d", "a", "c", "b", "e"]
    assert pick("top", time_filter="all") == ["b", "a", "c", "e", "d"]
    assert pick("top") == ["a", "c", "d"]
    assert pick("top", time_filter="day") == ["a", "d"]
    assert pick("top", time_filter="hour") == ["d"]
    assert pick("top", time_filter="month", limit=2) == ["b", "a"]
    assert pick("hot", limit=1) == ["d"] or pick("hot", limit=1) == ["a"]
    assert set(pick("rising")) == set("abcde")
    assert pick("controversial", time_filter="all")[0] == "b"


@pytest.mark.parametrize("how", POST_ORDERS)
def test_listing_limits(ranked, how):
    assert len(ids(listing(ranked, how, "all", 3, AS_OF))) == 3


def test_listing_pages(ranked):
    everything = listing(ranked, "top", "all", None, AS_OF).collect()
    second = everything[1]
    after = ids(listing(ranked, "top", "all", None, AS_OF, after=(second[RANK], second.id)))
    before = ids(listing(ranked, "top", "all", None, AS_OF, before=(second[RANK], second.id)))
    assert after == [r.id for r in everything[2:]] and before == [everything[0].id]


def test_bad_choices(ranked):
    for call in (
        lambda: listing(ranked, "bogus"),
        lambda: listing(ranked, "top", "decade"),
        lambda: comment_listing(ranked, "bogus"),
        lambda: search(ranked, "x", sort_by="bogus"),
    ):
        with pytest.raises(ValueError):
            call()


@pytest.fixture
def thread(spark):
    rows = [
        ("c1", "p", 5, "2024-01-01", False), ("c2", "p", -9, "2024-01-02", True),
        ("c3", "p", 0, "2024-01-03", False), ("d1", "q", 1, "2024-01-01", False),
    ]
    df = spark.createDataFrame(rows, "id string, post_id string, score int, t string, is_submitter boolean")
    return df.withColumn("created_utc", F.col("t").cast("timestamp"))


@pytest.mark.parametrize(
    "how,order",
    [
        ("best", ["c1", "c3", "c2"]), ("top", ["c1", "c3", "c2"]), ("new", ["c3", "c2", "c1"]),
        ("old", ["c1", "c2", "c3"]), ("controversial", ["c3", "c1", "c2"]), ("qa", ["c2", "c1", "c3"]),
    ],
)
def test_comment_listing(thread, how, order):
    assert how in COMMENT_ORDERS
    assert ids(comment_listing(thread, how)) == [*order, "d1"]
    assert ids(comment_listing(thread, how, limit=1)) == [order[0], "d1"]


def test_large_limits_give_the_same_rows(spark):
    df = spark.range(6000).select("id", (F.col("id") % 2).alias("g"), (F.hash("id") % 50).alias("s"))
    order = [F.col("s").desc(), F.col("id").asc()]
    got = sorted(r.id for r in first_per_group(df, "g", order, 1500).collect())
    rows = sorted(df.collect(), key=lambda r: (-r.s, r.id))
    want = [r.id for g in (0, 1) for r in [x for x in rows if x.g == g][:1500]]
    assert got == sorted(want)


def test_posts_with_comments(ranked, thread):
    kids = thread.withColumn("post_id", F.when(F.col("post_id") == "p", "b").otherwise("e"))
    got = posts_with_comments(ranked, kids, 1, "all", "top", 2, "top", AS_OF)
    assert ids(got.posts) == ["b"] and ids(got.comments) == ["c1", "c3"]


# Trees -----------------------------------------------------------------------


def breadth_first(rows):
    """Depth and root by walking queues, as an independent check."""
    found = {}
    queue = [(i, i, 0) for i, post, parent in rows if parent == post]
    kids = {}
    for i, post, parent in rows:
        kids.setdefault((post, parent), []).append(i)
    posts = {i: post for i, post, _ in rows}
    while queue:
        i, root, depth = queue.pop(0)
        found[i] = (root, depth)
        queue.extend((k, root, depth + 1) for k in kids.get((posts[i], i), []))
    return sorted((i, r, d) for i, (r, d) in found.items())


def test_walk(spark):
    rnd = random.Random(5)
    rows = []
    for p in range(4):
        names = []
        for n in range(60):
            parent = f"p{p}" if not names or rnd.random() < 0.1 else rnd.choice(names[-4:])
            names.append(f"{p}-{n}")
            rows.append((names[-1], f"p{p}", parent))
    rows += [("lost", "p1", "gone"), ("child", "p1", "lost")]
    rows += [("x", "p2", "y"), ("y", "p2", "z"), ("z", "p2", "x"), ("w", "p2", "x")]
    rows += [("other-post", "p3", "0-0")]
    df = spark.createDataFrame(rows, "id string, post_id string, parent_id string")
    assert values(walk(df), "id", "root_id", "walk_depth") == breadth_first(rows)
    assert roots(df).count() == sum(1 for _, post, parent in rows if parent == post)


def test_walk_of_a_chain_and_order(spark):
    rows = [(f"n{i:03d}", "p", "p" if i == 0 else f"n{i - 1:03d}", i) for i in range(70)]
    rows += [("r2", "p", "p", -1), ("s1", "p", "r2", 500), ("s0", "p", "r2", 400)]
    df = spark.createDataFrame(rows, "id string, post_id string, parent_id string, seq int")
    got = walk(df, sibling_order="seq")
    assert got.agg(F.max("walk_depth")).first()[0] == 69
    order = ids(got.orderBy("post_id", "walk_depth", "walk_path"))
    assert order[:5] == ["r2", "n000", "s0", "s1", "n001"]


def test_walk_of_nothing(spark):
    df = spark.createDataFrame([], "id string, post_id string, parent_id string")
    assert walk(df).count() == 0


# Search ----------------------------------------------------------------------


def test_search(spark):
    rows = [
        ("a", "Neural nets", "all about neural models", 1, 5, "2024-01-09"),
        ("b", "Cats", None, 9, 1, "2024-01-08"),
        ("c", "cats and neural cats", "cats", 3, 9, "2020-01-01"),
        ("d", None, None, 3, 9, "2024-01-01"),
    ]
    df = spark.createDataFrame(
        rows, "id string, title string, selftext string, score int, num_comments int, t string"
    ).withColumn("created_utc", F.col("t").cast("timestamp"))
    assert set(ids(search(df, "the NEURAL"))) == {"a", "c"}
    assert ids(search(df, "cats", sort_by="top")) == ["b", "c"]
    assert ids(search(df, "cats", sort_by="comments")) == ["c", "b"]
    assert ids(search(df, "cats", sort_by="new")) == ["b", "c"]
    assert len(ids(search(df, "cats", sort_by="hot"))) == 2
    assert ids(search(df, "cats", time_filter="week", as_of=AS_OF)) == ["b"]
    assert ids(search(df, "cats", limit=1)) == ["c"]
    assert ids(search(df, "the and")) == []


def test_bm25_values(spark):
    import math

    texts = ["red fish", "red red bird stone", "stone"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {
        r.id: r.relevance
        for r in search(df.withColumn("created_utc", F.current_timestamp()), "red stone", fields=["t"]).collect()
    }
    docs = [t.split() for t in texts]
    mean = sum(map(len, docs)) / 3
    for i, doc in enumerate(docs):
        want = 0.0
        for term in ("red", "stone"):
            seen = sum(term in d for d in docs)
            tf = doc.count(term)
            idf = math.log(1 + (3 - seen + 0.5) / (seen + 0.5))
            want += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean))
        assert got[i] == pytest.approx(want)


def test_walk_with_repeated_ids(frame):
    from threadloom.operators.rank import comment_order

    rows = [("a", "p", "p", 1), ("a", "p", "p", 1), ("b", "p", "a", 2), ("b", "p", "a", 2), ("c", "p", "lost", 3)]
    comments = frame(rows, "id string, post_id string, parent_id string, score int")
    assert values(walk(comments), "id", "walk_depth") == [("a", 0), ("a", 0), ("b", 1), ("b", 1)]
    placed = walk(comments, order=comment_order("top"))
    assert values(placed, "id", "walk_position") == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]


def test_walk_order_of_a_random_forest(spark):
    import random

    from threadloom.operators.rank import comment_order

    rng, rows = random.Random(6), []
    for post in ("p", "q"):
        for i in range(150):
            back = [r for r in rows if r[1] == post]
            parent = post if i < 3 or rng.random() < 0.1 else rng.choice(back[-12:])[0]
            rows.append((f"{post}{i}", post, parent, rng.randint(0, 5)))
    children, want = {}, {}
    for r in rows:
        children.setdefault(r[2], []).append(r)
    for post in ("p", "q"):
        level = sorted(children[post], key=lambda r: (-r[3], r[0]))
        place = 0
        while level:
            for r in level:
                place += 1
                want[r[0]] = place
            level = [c for r in level for c in sorted(children.get(r[0], []), key=lambda c: (-c[3], c[0]))]
    comments = spark.createDataFrame(rows, "id string, post_id string, parent_id string, score int")
    assert dict(values(walk(comments, order=comment_order("top")), "id", "walk_position")) == want


def test_nested_discussions(frame):
    import datetime as dt

    from threadloom.plans.collect import posts_with_comments

    at = dt.datetime(2024, 1, 1)
    posts = frame([("p", 5, at)], "id string, score int, created_utc timestamp")
    rows = [("a", "p", "p", 1, at), ("b", "p", "p", 9, at), ("c", "p", "a", 7, at), ("d", "p", "b", 3, at), ("e", "x", "x", 1, at)]
    comments = frame(rows, "id string, post_id string, parent_id string, score int, created_utc timestamp")
    found = posts_with_comments(posts, comments, 10, "all", "new", 3, "top", nested=True)
    assert [r.id for r in found.comments.collect()] == ["b", "a", "d"]
