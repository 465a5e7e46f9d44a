"""Stored postings: equal to a search over the texts, blocks skipped, right after every save."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.text import tokens
from threadloom.operators.search import bm25, query_terms
from threadloom.session import drop_path
from threadloom.sources.search_index import SearchIndex
from threadloom.sources.store import Store

SCHEMA = "id string not null, title string, selftext string, score int"
RNG = random.Random(3)
WORDS = [f"word{i}" for i in range(60)] + ["neural", "nets"]


def posts(spark, count, prefix="p"):
    rows = []
    for i in range(count):
        text = " ".join(RNG.choices(WORDS, k=RNG.randint(0, 40)))
        rows.append((f"{prefix}{i}", RNG.choice(["a title", "neural title", None]), text if i % 17 else None, i))
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return {r.id: r.relevance for r in df.select("id", "relevance").collect()}


@pytest.fixture
def index(spark, tmp_path):
    return SearchIndex(spark, str(tmp_path / "index"), block_rows=8)


def test_equals_a_search_over_the_texts(spark, index):
    table = posts(spark, 300)
    index.update(table)
    for query in ("neural nets", "Word7, word7 nets!", "word3", "absent"):
        want = found(bm25(table, query))
        assert found(index.bm25(query)) == want
        best = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:10]
        got = index.search(table, query, 10).collect()
        assert [(r.id, r.relevance) for r in got] == best
    assert index.bm25("of the").isEmpty() and index.bm25("...", 5).isEmpty()


def test_blocks_without_a_chance_are_skipped(spark, index):
    rows = [(f"p{i:04}", "", "neural " * (9 if i < 8 else 1) + "filler " * 30, i) for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    index.update(table)
    terms = query_terms(spark, "neural", index.options)
    weight = index._weights(terms, 1.2, 0.75)
    every, some = index.bounds(terms, weight), index.candidate_blocks(terms, weight, 5)
    assert every.count() > 40 and some.count() <= 8
    assert [r.id for r in index.search(table, "neural", 5).collect()] == [f"p{i:04}" for i in range(5)]


def test_only_the_postings_of_the_query_are_read(spark, index):
    index.update(posts(spark, 200))
    plan = index.bm25("neural nets")._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [" in plan.partition("PushedFilters")[2] and "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.partition("PartitionFilters")[2]
    assert "selftext" not in plan


def test_replaced_posts_are_neither_found_nor_counted(spark, index):
    first, again, more = posts(spark, 120), posts(spark, 50), posts(spark, 30, "q")
    index.update(first)
    second = again.unionByName(more)
    index.update(second)
    third = first.where("score < 20").withColumn("selftext", F.lit("nets nets nets"))
    index.update(third)
    now = third.unionByName(second.join(third, "id", "left_anti")).unionByName(first.join(second, "id", "left_anti").join(third, "id", "left_anti"))
    for query in ("neural nets", "word1 word2 word3"):
        assert found(index.bm25(query)) == found(bm25(now, query))
        want = sorted(found(bm25(now, query)).items(), key=lambda x: (-x[1], x[0]))[:7]
        assert [(r.id, r.relevance) for r in index.search(now, query, 7).collect()] == want


def test_a_store_keeps_its_postings(spark, tmp_path):
    schemas = {"posts": posts(spark, 1).schema}
    store = Store(spark, "table", str(tmp_path / "store"), schemas=schemas, max_parts=1, search={"posts": ["title", "selftext"]})
    assert store.search("posts", "neural").isEmpty()
    for part in range(4):  # full, part, sum or full again
        store.save_posts(posts(spark, 40 + 5 * part, "p" if part % 2 else "q"), order_by=["score"])
        table = store.posts()
        assert found(store.search("posts", "neural nets", None)) == found(bm25(table, "neural nets"))
    # A save that ended before its postings: the next search makes up for it.
    drop_path(spark, f"{tmp_path}/store/posts-postings/{sorted(p.name for p in (tmp_path / 'store/posts-postings').iterdir())[-1]}")
    assert found(store.search("posts", "neural nets", None)) == found(bm25(store.posts(), "neural nets"))


def test_edges(spark, index):
    assert index.version is None and index.bm25("neural").isEmpty()
    rows = [(None, "neural", "nets", 1), ("a", None, None, 2), ("b", "", "", 3), ("c", "neural neural", None, 4)]
    index.update(spark.createDataFrame(rows, SCHEMA.replace(" not null", "")))
    assert list(found(index.bm25("neural"))) == ["c"]
    with pytest.raises(ValueError):
        index.search(index.bm25("x"), "x", sort_by="best")


def test_postings_are_made_of_whole_blocks(spark, index):
    table = posts(spark, 300).unionByName(spark.createDataFrame([("e", None, None, 0)], SCHEMA))
    index.update(table)
    stored = spark.read.parquet(f"{index.root}/full-00000001/postings")
    rows = stored.collect()
    assert len({(r.term, r.block) for r in rows}) == len(rows)
    words = table.select("id", tokens(F.concat_ws(" ", "title", "selftext"), index.options).alias("w")).collect()
    counts = {(r.id, w): r.w.count(w) for r in words for w in set(r.w)}
    lengths = {r.id: len(r.w) for r in words}
    assert {(p.key, r.term): p.tf for r in rows for p in r.posts} == counts and sum(len(r.posts) for r in rows) == len(counts)
    for r in rows:
        assert r.n == len(r.posts) <= 8 and r.max_tf == max(p.tf for p in r.posts) and r.min_length == min(p.length for p in r.posts)
        assert all(p.length == lengths[p.key] for p in r.posts)
    written = spark.read.parquet(f"{index.root}/full-00000001/posts")
    plan = SearchIndex._postings(written, 1)._jdf.queryExecution().optimizedPlan().toString()
    # No row for each post and word is dealt out.
    assert "MapInArrow" in plan and "Generate" not in plan and "Aggregate" not in plan
