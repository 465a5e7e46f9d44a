"""Normalisation, filters, projections and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from threadloom.functions.scalars import (
    contains_any,
    epoch_to_timestamp,
    iso_to_timestamp,
    or_default,
    part,
    timestamp_to_iso,
)
from threadloom.operators import filters
from threadloom.operators.keywords import holds_keyword, keyword_hits
from threadloom.operators.sizing import spread
from threadloom.operators.transforms import add_fields, optional, records
from threadloom.sources.normalize import normalize_comments, normalize_community, normalize_posts

from .registry import RAW_COMMENTS_SQL, RAW_POSTS_SQL, check, instant, load, raw_comments, raw_posts


def plain_time(df, column="created_utc"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


STORED_POSTS_SQL = f"""
stored_posts AS (
  SELECT id, title, coalesce(author, '[deleted]') AS author, {instant('created_utc')} AS created_utc,
         score, upvote_ratio, num_comments, url, selftext, is_self, permalink,
         link_flair_text AS flair, "domain", is_video, is_original_content, subreddit
  FROM raw_posts)"""

STORED_COMMENTS_SQL = f"""
stored_comments AS (
  SELECT id, post_id, split_part(parent_id, '_', 2) AS parent_id,
         coalesce(author, '[deleted]') AS author, {instant('created_utc')} AS created_utc, score,
         body, permalink, "depth", is_submitter, subreddit
  FROM raw_comments)"""


@check("normalize_posts", f"WITH {RAW_POSTS_SQL}, {STORED_POSTS_SQL} SELECT * FROM stored_posts")
def posts(spark, folder):
    return plain_time(normalize_posts(raw_posts(spark, folder)))


@check("normalize_comments", f"WITH {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL} SELECT * FROM stored_comments")
def comments(spark, folder):
    return plain_time(normalize_comments(raw_comments(spark, folder)))


@check(
    "normalize_community",
    f"""SELECT source AS id, 'r-' || source AS name, upper(source) AS title, min(lang) AS description,
        max(lang) AS public_description, CAST(count(*) AS INTEGER) AS subscribers,
        {instant('1700000000.0 + min(doc_id)')} AS created_utc, max(n_chars) > 30000 AS over18,
        '/' || source AS url FROM documents GROUP BY source""",
)
def community(spark, folder):
    raw = load(spark, folder, "documents").groupBy("source").agg(
        F.expr("min(lang) AS description"),
        F.expr("max(lang) AS public_description"),
        F.expr("CAST(count(*) AS INT) AS subscribers"),
        F.expr("1700000000D + min(doc_id) AS created_utc"),
        F.expr("max(n_chars) > 30000 AS over18"),
    )
    shaped = raw.selectExpr(
        "source AS id", "concat('r-', source) AS display_name", "upper(source) AS title", "description",
        "public_description", "subscribers", "created_utc", "over18", "concat('/', source) AS url",
    )
    return plain_time(normalize_community(shaped))


# Filters -----------------------------------------------------------------------

START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)
BETWEEN = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'"


@check("filter_date_range", f"SELECT * FROM events WHERE {BETWEEN}")
def filter_date_range(spark, folder):
    return filters.by_date(load(spark, folder, "events"), "ts", START, END)


@check(
    "filter_date_text",
    f"""SELECT event_id, CASE event_type WHEN 'error' THEN 'n/a'
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS seen
        FROM events WHERE event_type <> 'error' AND {BETWEEN}""",
)
def filter_date_text(spark, folder):
    events = load(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("seen"),
    )
    return filters.by_date(events, "seen", START, END)


# The same moments in eight shapes of ISO text; the last one is no date.
SHAPES_SQL = r"""SELECT event_id, CASE event_id % 8
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
      WHEN 1 THEN strftime(ts, '%Y%m%dT%H%M%S.%f')
      WHEN 2 THEN strftime(ts, '%G-W%V-%u %H:%M:%S.%f')
      WHEN 3 THEN strftime(ts, '%GW%V%ux%H%M%S,%f')
      WHEN 4 THEN strftime(ts, '%Y-%m-%d_%H%M%S.%f') || 'Z'
      WHEN 5 THEN strftime(ts + INTERVAL 19815 SECONDS, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30:15'
      WHEN 6 THEN strftime(ts - INTERVAL 3 HOURS, '%Y%m%d#%H:%M:%S.%f') || '000-03'
      ELSE strftime(ts, '%Y-%m-%d') || ' no time' END AS seen
    FROM events"""


@check(
    "filter_date_shapes",
    f"""SELECT s.event_id, s.seen, ts FROM ({SHAPES_SQL}) s JOIN events e ON s.event_id = e.event_id
        WHERE s.event_id % 8 < 7 AND {BETWEEN}""",
)
def filter_date_shapes(spark, folder):
    def fmt(shape, moment="ts"):
        return f'date_format({moment}, "{shape}")'

    week = "concat(extract(YEAROFWEEK FROM ts), '{}', lpad(extract(WEEK FROM ts), 2, '0'), '{}', extract(DOW_ISO FROM ts), '{}', {})"
    shapes = [
        fmt("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        fmt("yyyyMMdd'T'HHmmss.SSSSSS"),
        week.format("-W", "-", " ", fmt("HH:mm:ss.SSSSSS")),
        week.format("W", "", "x", fmt("HHmmss,SSSSSS")),
        f"concat({fmt('yyyy-MM-dd_HHmmss.SSSSSS')}, 'Z')",
        f"""concat({fmt("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ts + make_dt_interval(0, 5, 30, 15)")}, '+05:30:15')""",
        f"""concat({fmt("yyyyMMdd'#'HH:mm:ss.SSSSSS", "ts - make_dt_interval(0, 3)")}, '000-03')""",
    ]
    cases = " ".join(f"WHEN {i} THEN {shape}" for i, shape in enumerate(shapes))
    events = load(spark, folder, "events").selectExpr(
        "event_id", f"CASE event_id % 8 {cases} ELSE concat({fmt('yyyy-MM-dd')}, ' no time') END AS seen"
    )
    kept = filters.by_date(events, "seen", START, END)
    return kept.withColumn("ts", iso_to_timestamp(F.col("seen")).cast("timestamp_ntz"))


@check("filter_equality_types", "SELECT event_id, event_type, value FROM events WHERE event_type = 'click' AND user_id = 3")
def filter_equality_types(spark, folder):
    """Values of another type match nothing and do not stop the job."""
    events = load(spark, folder, "events")
    kept = filters.by_equality(events, {"event_type": "click", "user_id": 3.0})
    for given in ({"event_type": 7}, {"user_id": "3"}, {"value": "much"}, {"ts": 5}, {"ts": "never"}, {"user_id": 1 << 70}):
        kept = kept.unionByName(filters.by_equality(events, given))
    return kept.select("event_id", "event_type", "value")


@check(
    "filter_score_range",
    "SELECT * FROM orders WHERE o_totalprice >= 1000.5 AND o_totalprice <= 250000",
)
def filter_score_range(spark, folder):
    return filters.by_score(load(spark, folder, "orders"), "o_totalprice", 1000.5, 250000)


@check(
    "filter_expr",
    "SELECT * FROM lineitem WHERE l_quantity * l_discount > 1.5 AND l_returnflag <> 'R'",
)
def filter_expr(spark, folder):
    items = filters.by_expr(load(spark, folder, "lineitem"), "l_quantity * l_discount > 1.5")
    return filters.by_expr(items, F.col("l_returnflag") != "R")


@check(
    "filter_function",
    "SELECT doc_id, lang FROM documents WHERE n_chars > 1000 AND lang = 'en'",
)
def filter_function(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    kept = filters.by_expr(docs, lambda rows: (rows["n_chars"] > 1000) & (rows["lang"] == "en"))
    return kept.select("doc_id", "lang")


KEYWORDS = ["tion", "schland", "éo"]


@check(
    "filter_keywords",
    "SELECT doc_id, text FROM documents WHERE "
    + " OR ".join(f"contains(lower(text), '{k}')" for k in KEYWORDS),
)
def filter_keywords(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return filters.by_keywords(docs, KEYWORDS, "text")


@check("filter_equality", "SELECT * FROM events WHERE event_type = 'click' AND user_id = 7")
def filter_equality(spark, folder):
    return filters.by_equality(load(spark, folder, "events"), {"event_type": "click", "user_id": 7})


@check(
    "filter_null_value",
    f"WITH {RAW_POSTS_SQL} SELECT id, subreddit FROM raw_posts WHERE author IS NULL AND subreddit = 'en'",
)
def filter_null_value(spark, folder):
    found = filters.by_equality(
        raw_posts(spark, folder), {"author": None, "subreddit": "en", "nowhere": 1}, on_unknown="ignore"
    )
    return found.select("id", "subreddit")


@check("filter_missing", f"WITH {RAW_POSTS_SQL} SELECT id, upvote_ratio FROM raw_posts WHERE upvote_ratio IS NOT NULL")
def filter_missing(spark, folder):
    return filters.having(raw_posts(spark, folder).select("id", "upvote_ratio"), "upvote_ratio")


# Projections -------------------------------------------------------------------


@check(
    "derive_fields",
    """SELECT l_orderkey, l_linenumber, l_quantity + 1 AS l_quantity, l_quantity * 2 AS doubled,
       l_extendedprice * (1 - l_discount) AS revenue FROM lineitem""",
)
def derive_fields(spark, folder):
    items = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    derived = add_fields(
        items,
        {
            "l_quantity": "l_quantity + 1",
            "doubled": F.col("l_quantity") * 2,
            "revenue": lambda df: df["l_extendedprice"] * (1 - df["l_discount"]),
        },
    )
    return derived.drop("l_extendedprice", "l_discount")


@check("optional_columns", "SELECT doc_id, lang, CAST(NULL AS DOUBLE) AS rating FROM documents")
def optional_columns(spark, folder):
    docs = load(spark, folder, "documents")
    return docs.select("doc_id", optional(docs, "lang", "string").alias("lang"), optional(docs, "rating", "double").alias("rating"))


@check("stored_columns", "SELECT doc_id, source FROM documents")
def stored_columns(spark, folder):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType())])
    return records(load(spark, folder, "documents"), schema)


# Scalars -----------------------------------------------------------------------

ISO = """strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_trunc('second', ts) = ts THEN ''
         ELSE strftime(ts, '.%f') END"""


@check(
    "scalar_times",
    f"""SELECT event_id, {instant('1700000000.0 + event_id / 8')} AS from_epoch, {ISO} AS iso,
        ts AS parsed FROM events""",
)
def scalar_times(spark, folder):
    events = load(spark, folder, "events").select("event_id", "ts")
    iso = timestamp_to_iso(F.col("ts"))
    return events.select(
        "event_id",
        epoch_to_timestamp(F.lit(1_700_000_000.0) + F.col("event_id") / 8).cast("timestamp_ntz").alias("from_epoch"),
        iso.alias("iso"),
        iso_to_timestamp(iso).cast("timestamp_ntz").alias("parsed"),
    )


@check(
    "scalar_texts",
    f"""WITH {RAW_COMMENTS_SQL} SELECT id, coalesce(author, '[deleted]') AS author,
        split_part(parent_id, '_', 2) AS parent, split_part(id, '-', 2) AS turn,
        contains(lower(body), 'tion') OR contains(lower(body), 'der') AS hit FROM raw_comments""",
)
def scalar_texts(spark, folder):
    return raw_comments(spark, folder).select(
        "id",
        or_default(F.col("author"), "[deleted]").alias("author"),
        part(F.col("parent_id"), "_", 1).alias("parent"),
        part(F.col("id"), "-", 1).alias("turn"),
        contains_any(F.col("body"), ["tion", "der"]).alias("hit"),
    )


# Thousands of keywords: 5,000 words of the documents themselves, chosen by a digest.
MANY_SQL = """many AS (
  SELECT word FROM (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM documents) w
  WHERE length(word) BETWEEN 4 AND 20 ORDER BY md5(word), word LIMIT 5000)"""


def many_keywords(docs):
    listed = docs.select(F.explode(F.split(F.lower("text"), " ", -1)).alias("word")).where("length(word) BETWEEN 4 AND 20").distinct()
    return [r[0] for r in listed.orderBy(F.md5("word"), "word").limit(5000).collect()]


@check(
    "filter_many_keywords",
    f"WITH {MANY_SQL} SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM many WHERE contains(lower(text), word))",
)
def filter_many_keywords(spark, folder):
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    return holds_keyword(docs, many_keywords(docs), "text").select("doc_id")


@check(
    "keyword_hits",
    f"""WITH {MANY_SQL}, hits AS (SELECT doc_id, word FROM documents JOIN many ON contains(lower(text), word))
    SELECT d.doc_id, count(word) AS n_keywords, md5(coalesce(string_agg(word, ' ' ORDER BY md5(word), word), '')) AS digest
    FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id""",
)
def all_keyword_hits(spark, folder):
    """Which of 5,000 keywords every document holds, in one pass over its text."""
    docs = spread(load(spark, folder, "documents").select("doc_id", "text"))
    found = keyword_hits(docs, many_keywords(docs), "text")
    return found.select("doc_id", F.size("keywords").cast("long").alias("n_keywords"), F.md5(F.array_join("keywords", " ")).alias("digest"))
