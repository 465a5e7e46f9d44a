"""Whole jobs: cleaning, preparation, the end-to-end run, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from threadloom.plans.clean import clean_comments, clean_posts
from threadloom.plans.prepare import prepare_for_analysis
from threadloom.plans.run import run
from threadloom.session import work_path
from threadloom.sources.files import write_files
from threadloom.sources.normalize import normalize_comments, normalize_posts
from threadloom.sources.store import Store
from threadloom.streaming.flow import clean_stream, upsert_stream
from threadloom.streaming.state import keep_last_stream, use_state

from .registry import CRAWLED_POSTS_SQL, RAW_COMMENTS_SQL, check, crawled_posts, instant, load, raw_comments
from .rows import STORED_COMMENTS_SQL, plain_time
from .stores import schema_of
from .texts import clean_sql

SINCE = dt.datetime(2023, 11, 14, 22, 30)
SINCE_SQL = "TIMESTAMP '2023-11-14 22:30:00'"

CLEANED_POSTS_SQL = f"""WITH {CRAWLED_POSTS_SQL},
    latest AS (SELECT * FROM crawled QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc DESC) = 1)
    SELECT id, {clean_sql('title')} AS title, coalesce(author, '[deleted]') AS author,
           {instant('created_utc')} AS created_utc, score, {clean_sql('selftext')} AS selftext, "domain"
    FROM latest WHERE {instant('created_utc')} >= {SINCE_SQL} AND score >= 300"""


@check("clean_posts", CLEANED_POSTS_SQL)
def cleaned_posts(spark, folder):
    posts = normalize_posts(crawled_posts(spark, folder)).select(
        "id", "title", "author", "created_utc", "score", "selftext", "domain"
    )
    return plain_time(clean_posts(posts, min_score=300, start_date=SINCE, unique_order=True))


@check(
    "clean_comments",
    f"""WITH {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL}
    SELECT id, post_id, author, score, {clean_sql('body')} AS body FROM stored_comments
    WHERE score >= 0 AND created_utc >= {SINCE_SQL}""",
)
def cleaned_comments(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder))
    got = clean_comments(comments, min_score=0, start_date=SINCE, unique_order=True)
    return got.select("id", "post_id", "author", "score", "body")


@check(
    "prepare_analysis",
    f"""WITH {CRAWLED_POSTS_SQL}, {RAW_COMMENTS_SQL}
    SELECT 'posts' AS tbl, id, author IS NULL AS deleted FROM crawled
    UNION ALL SELECT 'comments', id, author IS NULL FROM raw_comments""",
)
def prepared(spark, folder):
    frames = prepare_for_analysis(
        normalize_posts(crawled_posts(spark, folder)), normalize_comments(raw_comments(spark, folder))
    )
    parts = [
        df.select(F.lit(name).alias("tbl"), "id", (F.col("author") == "[deleted]").alias("deleted"))
        for name, df in frames.items()
    ]
    return parts[0].unionByName(parts[1])


@check(
    "run_report",
    f"""WITH {CRAWLED_POSTS_SQL}, {RAW_COMMENTS_SQL},
    latest AS (SELECT * FROM crawled QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_utc DESC) = 1),
    posts AS (SELECT count(*) AS n FROM latest WHERE score >= 100),
    comments AS (SELECT count(*) AS n FROM raw_comments
                 WHERE score >= 100 AND post_id IN (SELECT id FROM crawled))
    SELECT 'posts' AS tbl, n AS rows_expected, n AS rows_stored, CAST(0 AS BIGINT) AS keys_missing,
           CAST(0 AS BIGINT) AS keys_surplus FROM posts
    UNION ALL SELECT 'comments', n, n, 0, 0 FROM comments""",
)
def run_report(spark, folder):
    store = Store(spark, "table", work_path(spark, "run-store"))
    report = run(
        crawled_posts(spark, folder), raw_comments(spark, folder), store,
        limit=None, sort_by="new", min_score=100, clean_text=True,
    )
    parts = [df.select(F.lit(name).alias("tbl"), "*") for name, df in report.items()]
    return parts[0].unionByName(parts[1])


# Streams ------------------------------------------------------------------------


def as_stream(spark, df, label, files):
    """The rows of a table as a file stream: one or more files, one per micro-batch."""
    path = work_path(spark, label)
    write_files(df.repartition(files), "parquet", path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


@check(
    "stream_clean",
    f"SELECT conv_id, turn, {clean_sql('text')} AS text FROM conversations WHERE turn >= 1",
)
def stream_clean(spark, folder):
    turns = load(spark, folder, "conversations").select("conv_id", "turn", "text")
    stream = as_stream(spark, turns, "turns", 4)
    out, state = work_path(spark, "cleaned"), work_path(spark, "cleaned-state")
    cleaned = clean_stream(stream, ["text"], min_score=1, score="turn")
    query = (
        cleaned.writeStream.format("parquet").option("checkpointLocation", state)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.schema(turns.schema).parquet(out)


@check(
    "stream_upsert",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_upsert(spark, folder):
    """Events arrive in time order; the store keeps the last event of every user."""
    events = load(spark, folder, "events")
    path = work_path(spark, "events")
    # One folder per quarter of the time range, appended in order.
    ranged = events.repartitionByRange(4, "ts").sortWithinPartitions("ts")
    write_files(ranged.withColumn("part", F.spark_partition_id()), "parquet", path + "/all")
    stored = spark.read.parquet(path + "/all")
    store = Store(spark, "table", work_path(spark, "latest"), "user_id", {"events": schema_of(events, "user_id")})
    state, source = work_path(spark, "latest-state"), path + "/in"
    for part in range(4):
        write_files(stored.where(F.col("part") == part).drop("part"), "parquet", source, mode="append")
        stream = spark.readStream.schema(events.schema).parquet(source)
        upsert_stream(stream, store, "events", state, ["ts", "event_id"], True, available_now=True).awaitTermination()
    return store.read("events")


@check(
    "stream_upsert_unsorted",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_upsert_unsorted(spark, folder):
    """Events arrive in any order; newer stored rows stay, however the rows are cut into batches."""
    events = load(spark, folder, "events")
    store = Store(spark, "table", work_path(spark, "newest"), "user_id", {"events": schema_of(events, "user_id")})
    source, state = work_path(spark, "shuffled"), work_path(spark, "newest-state")
    for part in range(3):
        some = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part)
        write_files(some, "parquet", source, mode="append")
        stream = spark.readStream.schema(events.schema).parquet(source)
        upsert_stream(
            stream, store, "events", state, ["ts", "event_id"], True, available_now=True, keep_newer=True
        ).awaitTermination()
    return store.read("events")


@check(
    "stream_keep_last",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def stream_keep_last(spark, folder):
    """Events arrive in any order; the state keeps the last one of every user and puts it out when the watermark passes."""
    events = load(spark, folder, "events")
    use_state(spark)
    source, out, state = (work_path(spark, f"keep-last-{n}") for n in ("in", "out", "state"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    span = last - first + dt.timedelta(minutes=1)
    end = events.limit(1).select(
        *[F.lit(last + 2 * span).cast(f.dataType).alias("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
    )
    parts = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part) for part in range(3)]
    for some in [*parts, end]:  # the last row only moves the watermark beyond all others
        write_files(some, "parquet", source, mode="append")
        stream = spark.readStream.schema(events.schema).parquet(source)
        kept = keep_last_stream(stream, "user_id", "ts", ["event_id"], lateness=f"{int(span.total_seconds())} seconds")
        writer = kept.writeStream.format("parquet").option("checkpointLocation", state)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(events.schema).parquet(out)
