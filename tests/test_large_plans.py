"""The plans used beyond the broadcast threshold, with a third of all rows on one key."""

import re

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

import threadloom as tl
from checks.compare import compare, connect

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # Small enough that adaptive execution splits partitions of the test data.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
}


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize(
    "name",
    [
        "upsert_merge_columns", "upsert_merge_columns_lookup", "upsert_replace", "upsert_append",
        "upsert_wider_batch", "lemma_tokens", "lemma_repeated_keys", "lemma_tokens_join", "posts_with_comments", "comment_collection", "comment_parent", "known_keys",
        "orphans", "comment_counts", "comment_tree", "post_features_by", "listed_discussions",
        "store_upsert_table", "search_bm25", "clean_posts",
    ],
)
def test_without_broadcast(spark, con, name):
    good, note = compare(spark, con, SF, name)
    assert good, note


@pytest.fixture
def hot(spark):
    """3,000 comments, 1,000 of them answers to one post, in a shallow tree."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 40)).alias("post_id"),
        F.col("id").alias("n"),
        F.repeat(F.lit("x"), 50).alias("body"),
    )
    # Every third comment answers comment 0, which is a root of the hot post.
    parent = F.when((F.col("post_id") == "hot") & (F.col("n") > 0), F.lit("0")).otherwise(F.col("post_id"))
    return rows.withColumn("parent_id", parent).repartition(8)


@pytest.fixture
def posts(spark):
    return spark.range(41).select(
        F.when(F.col("id") == 40, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("id")
    )


def test_hot_post_joins(hot, posts):
    assert tl.with_children(posts, hot).count() == 3000
    assert dict(values(tl.child_counts(posts, hot), "id", "comment_count"))["hot"] == 1000
    assert tl.orphans(hot, posts).count() == 0


def test_hot_post_collections(hot, posts):
    rows = tl.collections(posts, hot, ["n"], chunk_size=100).collect()
    assert sorted(c.n for r in rows for c in r.comments) == list(range(3000))
    own = sorted((r.chunk, [c.n for c in r.comments]) for r in rows if r.id == "hot")
    assert [len(c) for _, c in own] == [100] * 10 and [n for _, c in own for n in c] == list(range(0, 3000, 3))


def test_equal_children_are_cut_as_well(hot, posts):
    same = hot.select("post_id", F.lit(True).alias("flag"))
    rows = tl.collections(posts, same, ["flag"], chunk_size=64).where("id = 'hot'").collect()
    assert max(len(r.comments) for r in rows) == 64 and sum(len(r.comments) for r in rows) == 1000


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_dealt_by_chunk(hot, posts):
    plan = executed(tl.collections(posts, hot, ["n"], chunk_size=100))
    assert re.search(r"Exchange hashpartitioning\(_join_key#\d+, (chunk|_groupingexpression)#", plan)


def test_left_join_splits_the_hot_post(hot, posts):
    joined = tl.with_children(posts, hot.where("post_id <> 'p1'"), how="left")
    assert "skew=true" in executed(joined)
    assert joined.where("comment_id IS NULL").count() == 1 and joined.count() == hot.where("post_id <> 'p1'").count() + 1


@pytest.mark.parametrize("limit", [5, 1500])
def test_hot_post_is_split_after_the_semi_join(hot, posts, limit):
    from threadloom.plans.collect import posts_with_comments

    scored = hot.withColumns({"score": F.col("n"), "created_utc": F.timestamp_seconds("n")})
    found = posts_with_comments(posts.withColumns({"score": F.lit(1), "created_utc": F.timestamp_seconds(F.lit(1))}), scored, None, "all", "new", limit, "top", ordered=False)
    plan = executed(found.comments)
    assert ("_slice" in plan) if limit == 5 else ("_number_of_piece" in plan)
    best = sorted(r.n for r in found.comments.where("post_id = 'hot'").collect())
    assert best == list(range(0, 3000, 3))[-limit:]


def test_hot_parent_tree(hot):
    got = tl.walk(hot)
    assert got.count() == 3000
    assert got.where("walk_depth = 1 AND root_id = '0'").count() == 999


def test_hot_key_dedup_and_merge(hot):
    last = tl.keep_last(hot, "post_id", ["n"], unique_order=True)
    assert dict(values(last, "post_id", "n"))["hot"] == 2997
    base = last.select("post_id", F.lit("kept").alias("other"))
    merged = tl.merge_columns(base, hot.select("post_id", "n"), "post_id", ["n"], unique_order=True)
    assert dict(values(merged, "post_id", "n"))["hot"] == 2997 and merged.count() == last.count()


def test_hot_post_listing(hot):
    listing = tl.comment_listing(hot.withColumn("score", F.col("n")), "top", 1500, created="n")
    got = listing.where("post_id = 'hot'").collect()
    assert [r.n for r in got] == sorted((r.n for r in got), reverse=True) and len(got) == 1000


def test_adaptive_execution_splits_the_hot_post(spark, hot, posts):
    joined = tl.with_children(posts, hot)
    assert len(joined.collect()) == 3000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
