"""Registration of queries and the stand-in tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.sizing import spread
from threadloom.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its oracle."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(ship(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Raw posts: every document with its label, shaped like a collector record.
RAW_POSTS_SQL = """
raw_posts AS (
  SELECT 'p' || d.doc_id AS id, 'Notes from ' || d.source || ' in ' || d.lang AS title,
         CASE WHEN l.toxic = 1 THEN NULL ELSE 'user-' || d.source END AS author,
         1700000000.0 + d.doc_id * 37.5 AS created_utc, CAST(d.n_chars AS INTEGER) AS score,
         CAST(CASE l.quality WHEN 1 THEN 0.9 WHEN 0 THEN 0.6 END AS DOUBLE) AS upvote_ratio,
         CAST(coalesce(l.quality, 0) AS INTEGER) AS num_comments,
         'https://' || d.source || '.example.org/' || d.doc_id AS url, d.text AS selftext,
         coalesce(l.quality, 0) = 1 AS is_self, '/' || d.source || '/' || d.doc_id AS permalink,
         d.lang AS link_flair_text, d.source AS "domain", l.toxic = 1 AS is_video,
         CAST(NULL AS BOOLEAN) AS is_original_content, d.lang AS subreddit
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(load(spark, folder, "documents"))
    joined = documents.join(load(spark, folder, "labels"), "doc_id", "left")
    return joined.selectExpr(
        "concat('p', doc_id) AS id",
        "concat('Notes from ', source, ' in ', lang) AS title",
        "CASE WHEN toxic = 1 THEN NULL ELSE concat('user-', source) END AS author",
        "1700000000D + doc_id * 37.5D AS created_utc",
        "CAST(n_chars AS INT) AS score",
        "CASE quality WHEN 1 THEN 0.9D WHEN 0 THEN 0.6D END AS upvote_ratio",
        "coalesce(quality, 0) AS num_comments",
        "concat('https://', source, '.example.org/', doc_id) AS url",
        "text AS selftext",
        "coalesce(quality, 0) = 1 AS is_self",
        "concat('/', source, '/', doc_id) AS permalink",
        "lang AS link_flair_text",
        "source AS domain",
        "toxic = 1 AS is_video",
        "CAST(NULL AS BOOLEAN) AS is_original_content",
        "lang AS subreddit",
    )


# Raw comments: every conversation turn; turn 0 answers the post, turn t the turn (t-1)/2.
RAW_COMMENTS_SQL = """
raw_comments AS (
  SELECT 'c' || conv_id || '-' || turn AS id, 'p' || conv_id AS post_id,
         CASE WHEN turn = 0 THEN 't3_p' || conv_id
              ELSE 't1_c' || conv_id || '-' || CAST(floor((turn - 1) / 2) AS BIGINT) END AS parent_id,
         nullif(role, 'system') AS author, 1700000000.0 + conv_id * 3600 + turn * 60 AS created_utc,
         CAST(length(text) - 200 AS INTEGER) AS score, text AS body, '/c/' || conv_id AS permalink,
         CAST(floor(log2(turn + 1)) AS INTEGER) AS "depth", role = 'user' AS is_submitter,
         role AS subreddit
  FROM conversations)"""


def raw_comments(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "conversations").selectExpr(
        "concat('c', conv_id, '-', turn) AS id",
        "concat('p', conv_id) AS post_id",
        "CASE WHEN turn = 0 THEN concat('t3_p', conv_id) "
        "ELSE concat('t1_c', conv_id, '-', (turn - 1) DIV 2) END AS parent_id",
        "nullif(role, 'system') AS author",
        "1700000000D + conv_id * 3600 + turn * 60 AS created_utc",
        "CAST(length(text) - 200 AS INT) AS score",
        "text AS body",
        "concat('/c/', conv_id) AS permalink",
        "CAST(floor(log2(turn + 1)) AS INT) AS depth",
        "role = 'user' AS is_submitter",
        "role AS subreddit",
    )


# A second crawl returns the labelled posts again a day later with a changed score.
CRAWLED_POSTS_SQL = (
    RAW_POSTS_SQL
    + """,
crawled AS (
  SELECT * FROM raw_posts
  UNION ALL BY NAME
  SELECT r.* REPLACE (r.created_utc + 86400.0 AS created_utc, r.score + 1 - 2 * l.quality AS score)
  FROM raw_posts r JOIN labels l ON r.id = 'p' || l.doc_id)"""
)


def crawled_posts(spark: SparkSession, folder: str) -> DataFrame:
    first = raw_posts(spark, folder)
    labels = load(spark, folder, "labels").selectExpr("concat('p', doc_id) AS id", "quality")
    second = first.join(labels, "id").withColumns(
        {
            "created_utc": F.col("created_utc") + 86400.0,
            "score": (F.col("score") + 1 - 2 * F.col("quality")).cast("int"),
        }
    )
    return first.unionByName(second.drop("quality"))


def instant(seconds: str) -> str:
    """SQL for the UTC timestamp of epoch seconds."""
    return f"make_timestamp(CAST(round(({seconds}) * 1000000) AS BIGINT))"
