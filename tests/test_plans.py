"""The physical plans that the design relies on."""

import datetime as dt
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import threadloom as tl
from threadloom.operators.rank import first_per_group
from threadloom.session import work_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def test_text_cleaning_is_narrow_and_native(docs):
    text = plan(docs.select("doc_id", tl.clean(F.col("text"))))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_stemming_does_not_shuffle(docs):
    text = plan(docs.select(tl.clean(F.col("text"), tl.TextOptions(stemming=True))))
    assert "ArrowEvalPython" in text and "Exchange" not in text


def test_small_lemma_table_does_not_shuffle(spark, docs):
    lemmas = spark.sql("SELECT 'words' AS word, 'word' AS lemma")
    assert "Exchange" not in plan(tl.lemmatize(docs, "text", lemmas))
    joined = plan(tl.lemmatize(docs, "text", lemmas, "join"))
    assert "Python" not in joined


@pytest.mark.parametrize(
    "kind,bound", [("timestamp_ntz", "GreaterThanOrEqual(ts,2024-01-05T00:00)"), ("timestamp", "GreaterThanOrEqual(ts,2024-01-05 00:00:00.0)")]
)
def test_date_bounds_reach_the_scan(spark, events, kind, bound):
    path = work_path(spark, "times")
    events.select(F.col("ts").cast(kind).alias("ts")).write.parquet(path)
    text = plan(tl.by_date(spark.read.parquet(path), "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)))
    assert bound in text and "LessThanOrEqual(ts" in text


def test_filters_reach_the_scan(events):
    assert "EqualTo(event_type,click)" in plan(tl.by_equality(events, {"event_type": "click"}))
    assert "GreaterThanOrEqual(value,1.0)" in plan(tl.by_score(events, "value", 1.0))


def test_store_filters_reach_every_full_folder(spark):
    from threadloom.schemas import POSTS

    store = tl.create_store(spark, "table", work_path(spark, "pushed"))
    row = spark.range(3).selectExpr("CAST(id AS STRING) AS id", "'t' AS title", "'a' AS author",
        "timestamp_seconds(id) AS created_utc", "1 AS score", "0 AS num_comments", "'u' AS url",
        "true AS is_self", "'p' AS permalink", "'s' AS subreddit")
    store.save_posts(row, order_by=None)
    store.save_posts(row.where("id = '1'").withColumn("score", F.lit(5)), order_by=None)
    found = store.posts({"subreddit": "s", "score": 1})
    assert "EqualTo(subreddit,s)" in plan(found) and found.count() == 2
    assert found.columns == POSTS.names


def test_dedup_has_one_shuffle(events):
    text = plan(tl.keep_last(events, "user_id", ["ts", "event_id"], unique_order=True))
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2


def test_listing_needs_no_full_sort(events):
    ranked = tl.listing(events, "top", "all", 10, key="event_id", created="ts", score="value")
    text = plan(ranked)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_per_post_limit_is_applied_before_the_shuffle(events):
    few = plan(first_per_group(events, "user_id", [F.col("value").desc()], 3))
    assert few.count("WindowGroupLimit") == 2 and few.count("Exchange") == 1
    many = plan(first_per_group(events, "user_id", [F.col("value").desc()], 5000))
    # Numbered by range pieces: what is joined and counted is a piece, never a whole user.
    assert "_number_of_piece" in many and "WindowGroupLimit" not in many


def test_whole_listing_is_ranged_not_grouped(events):
    text = plan(tl.comment_listing(events, "top", None, "user_id", score="value", created="ts", key="event_id"))
    assert "Window" not in text and "rangepartitioning(user_id" in text
    loose = tl.comment_listing(events, "top", None, "user_id", ordered=False, score="value", created="ts", key="event_id")
    assert "Exchange" not in plan(loose)


def test_search_tokenizes_each_text_once(spark, docs):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    posts = docs.select("doc_id", "text").mapInArrow(count, "doc_id long, text string").withColumn("created_utc", F.lit(0))
    found = tl.search(posts, "information thereed", fields=["text"], key="doc_id")
    text = plan(found)
    assert "_words" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    found.collect()
    assert seen.value == docs.count()


def test_features_are_combined_without_a_join(docs):
    posts = docs.select(F.col("n_chars").alias("score"), F.lit(1).alias("num_comments"), F.col("source").alias("domain"))
    text = plan(tl.post_features(posts))
    assert "Join" not in text and text.count("partial_count") >= 2


def test_joins_are_equi_joins(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for df in (
        tl.with_children(docs, labels, "doc_id", "doc_id"),
        tl.with_parent(labels, docs, "doc_id", "doc_id"),
        tl.orphans(docs, labels, "doc_id", "doc_id"),
        tl.child_counts(docs, labels, "doc_id", "doc_id"),
        tl.collections(docs, labels, ["quality"], "doc_id", "doc_id"),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_words_without_a_lemma_are_not_sorted_by_text(spark, docs):
    lemmas = spark.sql("SELECT 'words' AS word, 'word' AS lemma")
    text = tl.lemmatize(docs, "text", lemmas, "join")._jdf.queryExecution().optimizedPlan().toString()
    # The join takes the words as they are cut out, no aggregate stands between.
    assert re.search(r"Join Inner[^\n]*\n(?:[^\n]*(?:Project|Filter)[^\n]*\n)*[^\n]*Generate explode", text), text
