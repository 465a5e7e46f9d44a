"""Features, value counts and step metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators.features import comment_features, post_features, share, top_values
from threadloom.operators.metrics import StepMetrics
from threadloom.plans.clean import clean_posts
from threadloom.plans.prepare import extract_features
from threadloom.sources.normalize import normalize_posts

from .registry import CRAWLED_POSTS_SQL, RAW_COMMENTS_SQL, RAW_POSTS_SQL, check, crawled_posts, load, raw_comments, raw_posts


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


POST_MEASURES = """round(avg(score), 6) AS avg_score, max(score) AS max_score,
    round(avg(num_comments), 6) AS avg_comments, count(*) AS total_posts,
    round(avg(CAST(is_self AS INTEGER)), 6) AS self_post_ratio"""
COMMENT_MEASURES = """round(avg(score), 6) AS avg_score, max(score) AS max_score,
    count(*) AS total_comments, round(avg("depth"), 6) AS avg_depth"""


def listed(column):
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["value"], x["count"].cast("string"))), " ")


@check(
    "post_features",
    f"""WITH {RAW_POSTS_SQL},
    top AS (SELECT "domain" AS v, count(*) AS n FROM raw_posts WHERE "domain" IS NOT NULL
            GROUP BY 1 ORDER BY n DESC, v LIMIT 10)
    SELECT {POST_MEASURES}, (SELECT string_agg(v || ':' || n, ' ' ORDER BY n DESC, v) FROM top) AS top_domains
    FROM raw_posts""",
)
def all_post_features(spark, folder):
    got = post_features(raw_posts(spark, folder))
    return rounded(got, "avg_score", "avg_comments", "self_post_ratio").withColumn("top_domains", listed("top_domains"))


@check(
    "post_features_by",
    f"""WITH {RAW_POSTS_SQL},
    counts AS (SELECT subreddit, "domain" AS v, count(*) AS n FROM raw_posts GROUP BY ALL),
    top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY n DESC, v) <= 10),
    lists AS (SELECT subreddit, string_agg(v || ':' || n, ' ' ORDER BY n DESC, v) AS top_domains FROM top GROUP BY 1)
    SELECT g.*, top_domains FROM (SELECT subreddit, {POST_MEASURES} FROM raw_posts GROUP BY subreddit) g
    JOIN lists l ON g.subreddit = l.subreddit""",
)
def post_features_by(spark, folder):
    got = post_features(raw_posts(spark, folder), ["subreddit"])
    return rounded(got, "avg_score", "avg_comments", "self_post_ratio").withColumn("top_domains", listed("top_domains"))


@check("comment_features", f"WITH {RAW_COMMENTS_SQL} SELECT {COMMENT_MEASURES} FROM raw_comments")
def all_comment_features(spark, folder):
    return rounded(comment_features(raw_comments(spark, folder)), "avg_score", "avg_depth")


@check(
    "comment_features_by",
    f"WITH {RAW_COMMENTS_SQL} SELECT post_id, {COMMENT_MEASURES} FROM raw_comments GROUP BY post_id",
)
def comment_features_by(spark, folder):
    return rounded(comment_features(raw_comments(spark, folder), ["post_id"]), "avg_score", "avg_depth")


@check(
    "extract_features",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}
    SELECT p.total_posts, p.avg_score AS post_avg_score, p.max_score AS post_max_score,
           c.total_comments, c.avg_score AS comment_avg_score, c.avg_depth
    FROM (SELECT {POST_MEASURES} FROM raw_posts) p, (SELECT {COMMENT_MEASURES} FROM raw_comments) c""",
)
def both_features(spark, folder):
    got = extract_features(raw_posts(spark, folder), raw_comments(spark, folder))
    return got.select(
        "post_features.total_posts",
        F.round("post_features.avg_score", 6).alias("post_avg_score"),
        F.col("post_features.max_score").alias("post_max_score"),
        "comment_features.total_comments",
        F.round("comment_features.avg_score", 6).alias("comment_avg_score"),
        F.round("comment_features.avg_depth", 6).alias("avg_depth"),
    )


@check(
    "top_values",
    "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey ORDER BY count DESC, l_partkey LIMIT 10",
)
def most_frequent(spark, folder):
    return top_values(load(spark, folder, "lineitem"), "l_partkey")


@check(
    "top_values_by",
    """WITH counts AS (SELECT l_returnflag, l_suppkey, count(*) AS count FROM lineitem GROUP BY ALL)
       SELECT * FROM counts
       QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY count DESC, l_suppkey) <= 10""",
)
def most_frequent_by(spark, folder):
    return top_values(load(spark, folder, "lineitem"), "l_suppkey", 10, ["l_returnflag"])


@check(
    "top_values_by_many",
    """WITH counts AS (SELECT l_returnflag, l_partkey, count(*) AS count FROM lineitem GROUP BY ALL)
       SELECT * FROM counts
       QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY count DESC, l_partkey) <= 1200""",
)
def many_frequent_by(spark, folder):
    return top_values(load(spark, folder, "lineitem"), "l_partkey", 1200, ["l_returnflag"])


@check(
    "post_features_by_flair",
    f"""WITH {RAW_POSTS_SQL},
    posts AS (SELECT * REPLACE (nullif(link_flair_text, 'en') AS link_flair_text) FROM raw_posts),
    counts AS (SELECT link_flair_text, "domain" AS v, count(*) AS n FROM posts GROUP BY ALL),
    top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY link_flair_text ORDER BY n DESC, v) <= 10),
    lists AS (SELECT link_flair_text, string_agg(v || ':' || n, ' ' ORDER BY n DESC, v) AS top_domains FROM top GROUP BY 1)
    SELECT g.*, top_domains FROM (SELECT link_flair_text, {POST_MEASURES} FROM posts GROUP BY link_flair_text) g
    JOIN lists l ON g.link_flair_text IS NOT DISTINCT FROM l.link_flair_text""",
)
def post_features_by_flair(spark, folder):
    """Features by a nullable column: the group without a value has its domains as well."""
    posts = raw_posts(spark, folder).withColumn("link_flair_text", F.nullif(F.col("link_flair_text"), F.lit("en")))
    got = post_features(posts, ["link_flair_text"])
    return rounded(got, "avg_score", "avg_comments", "self_post_ratio").withColumn("top_domains", listed("top_domains"))


@check(
    "flag_share",
    """SELECT event_type, round(avg(CAST(value > 50 AS INTEGER)), 6) AS large_share
       FROM events GROUP BY event_type""",
)
def flag_share(spark, folder):
    events = load(spark, folder, "events")
    return events.groupBy("event_type").agg(F.round(share(F.col("value") > 50), 6).alias("large_share"))


@check(
    "step_metrics",
    f"""WITH {CRAWLED_POSTS_SQL},
    latest AS (SELECT * FROM crawled QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc DESC) = 1)
    SELECT 'input' AS step, (SELECT count(*) FROM crawled) AS rows
    UNION ALL SELECT 'deduplicated', (SELECT count(*) FROM latest)
    UNION ALL SELECT 'score', (SELECT count(*) FROM latest WHERE score >= 1000)""",
)
def step_metrics(spark, folder):
    """Counts observed while the cleaning plan runs; the plan's rows go to a no-op sink."""
    metrics = StepMetrics()
    posts = normalize_posts(crawled_posts(spark, folder))
    cleaned = clean_posts(posts, clean_title=False, clean_selftext=False, min_score=1000, unique_order=True, metrics=metrics)
    cleaned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(metrics.rows().items()), "step string, rows bigint")
