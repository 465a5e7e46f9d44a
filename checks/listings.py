"""Ranked listings and search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from threadloom.operators.rank import comment_listing, listing
from threadloom.operators.search import search
from threadloom.operators.sizing import spread
from threadloom.plans.collect import posts_with_comments
from threadloom.session import work_path
from threadloom.sources.normalize import normalize_comments, normalize_posts
from threadloom.sources.store import Store

from .registry import RAW_COMMENTS_SQL, RAW_POSTS_SQL, check, load, raw_comments, raw_posts
from .rows import STORED_COMMENTS_SQL, STORED_POSTS_SQL
from .stores import schema_of
from .texts import tokens_sql

AS_OF = dt.datetime(2001, 8, 1)
ORDER_COLUMNS = dict(score="o_totalprice", key="o_orderkey", created="o_orderdate")


def order_listing(spark, folder, sort_by, time_filter="all", limit=100, **options):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return listing(orders, sort_by, time_filter, limit, AS_OF, **ORDER_COLUMNS, **options)


def orders_sql(rank: str, where: str = "TRUE", limit: int = 100) -> str:
    return f"""SELECT o_orderkey, o_totalprice, o_orderdate, {rank} AS rank_value FROM orders
               WHERE {where} ORDER BY rank_value DESC, o_orderkey LIMIT {limit}"""


EPOCH = "(epoch_us(o_orderdate) / 1000000.0)"
HOT = f"sign(o_totalprice) * log10(greatest(abs(o_totalprice), 1.0)) + {EPOCH} / 45000.0"
HOURS = f"((epoch_us(TIMESTAMP '2001-08-01') / 1000000.0 - {EPOCH}) / 3600.0)"


@check("listing_top", orders_sql("o_totalprice", "o_orderdate >= TIMESTAMP '2000-08-01'"))
def listing_top(spark, folder):
    return order_listing(spark, folder, "top", "year")


@check("listing_new", orders_sql("o_orderdate", limit=250))
def listing_new(spark, folder):
    return order_listing(spark, folder, "new", "week", limit=250)


def _six(df):
    return df.withColumn("rank_value", F.round("rank_value", 6))


@check("listing_hot", f"SELECT * REPLACE (round(rank_value, 6) AS rank_value) FROM ({orders_sql(HOT)})")
def listing_hot(spark, folder):
    return _six(order_listing(spark, folder, "hot"))


@check(
    "listing_rising",
    "SELECT * REPLACE (round(rank_value, 6) AS rank_value) FROM ("
    + orders_sql(f"o_totalprice / pow(greatest({HOURS}, 0.0) + 2.0, 1.8)")
    + ")",
)
def listing_rising(spark, folder):
    return _six(order_listing(spark, folder, "rising"))


@check(
    "listing_controversial",
    f"""WITH {RAW_POSTS_SQL}, {STORED_POSTS_SQL},
    votes AS (SELECT id, score, upvote_ratio * (score / (2 * upvote_ratio - 1)) AS ups,
                     (1 - upvote_ratio) * (score / (2 * upvote_ratio - 1)) AS downs FROM stored_posts)
    SELECT id, score, round(CASE WHEN ups > 0 AND downs > 0
        THEN pow(ups + downs, least(ups, downs) / greatest(ups, downs)) ELSE 0 END, 6) AS rank_value
    FROM votes ORDER BY rank_value DESC, id LIMIT 100""",
)
def listing_controversial(spark, folder):
    posts = normalize_posts(raw_posts(spark, folder))
    return _six(listing(posts, "controversial", "all", 100)).select("id", "score", "rank_value")


@check(
    "listing_page",
    """WITH ranked AS (SELECT o_orderkey, o_totalprice, o_orderdate, o_totalprice AS rank_value FROM orders),
    mark AS (SELECT 250000.0 AS v, 700 AS k)
    SELECT r.* FROM ranked r, mark WHERE r.rank_value < v OR (r.rank_value = v AND o_orderkey > k)
    ORDER BY r.rank_value DESC, o_orderkey LIMIT 50""",
)
def listing_page(spark, folder):
    return order_listing(spark, folder, "top", "all", 50, after=(250000.0, 700))


@check(
    "listing_page_before",
    """WITH ranked AS (SELECT o_orderkey, o_totalprice, o_orderdate, o_totalprice AS rank_value FROM orders),
    mark AS (SELECT 250000.0 AS v, 700 AS k)
    SELECT r.* FROM ranked r, mark WHERE r.rank_value > v OR (r.rank_value = v AND o_orderkey < k)
    ORDER BY r.rank_value, o_orderkey DESC LIMIT 50""",
)
def listing_page_before(spark, folder):
    """The page that ends right ahead of a mark."""
    return order_listing(spark, folder, "top", "all", 50, before=(250000.0, 700))


@check(
    "comment_listing_many",
    """SELECT event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 1500""",
)
def many_comments(spark, folder):
    """More rows per group than Spark trims before a shuffle."""
    events = load(spark, folder, "events").select("event_id", "event_type", "value")
    return comment_listing(events, "top", 1500, "event_type", score="value", created="event_id", key="event_id")


@check(
    "comment_listing",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_extendedprice DESC, l_linenumber, l_shipdate) <= 3""",
)
def best_lines(spark, folder):
    items = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    # Line numbers repeat within an order, so the tie-break key is a struct.
    keyed = items.withColumn("k", F.struct("l_linenumber", "l_shipdate"))
    top = comment_listing(keyed, "top", 3, "l_orderkey", score="l_extendedprice", created="l_shipdate", key="k")
    return top.drop("k")


def comments_sql(order: str, limit: int) -> str:
    return f"""WITH {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL} SELECT id, post_id, score FROM stored_comments
       QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY {order}, id) <= {limit}"""


for _name, _order in {
    "best": "score DESC",
    "new": "created_utc DESC",
    "old": "created_utc",
    "controversial": "abs(score)",
    "qa": "is_submitter DESC, score DESC",
}.items():

    @check(f"comment_listing_{_name}", comments_sql(_order, 2))
    def comment_orders(spark, folder, name=_name):
        comments = normalize_comments(raw_comments(spark, folder))
        return comment_listing(comments, name, 2).select("id", "post_id", "score")


@check(
    "comment_listing_all",
    f"WITH {RAW_COMMENTS_SQL} SELECT id, post_id, score FROM raw_comments",
)
def every_comment(spark, folder):
    comments = normalize_comments(raw_comments(spark, folder))
    return comment_listing(comments, "top").select("id", "post_id", "score")


@check(
    "listed_discussions",
    f"""WITH {RAW_POSTS_SQL}, {RAW_COMMENTS_SQL}, {STORED_COMMENTS_SQL},
    listed AS (SELECT id FROM raw_posts ORDER BY score DESC, id LIMIT 100)
    SELECT id, post_id, score FROM stored_comments WHERE post_id IN (SELECT id FROM listed)
    QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY score DESC, id) <= 5""",
)
def listed_discussions(spark, folder):
    found = posts_with_comments(
        normalize_posts(raw_posts(spark, folder)),
        normalize_comments(raw_comments(spark, folder)),
        100, "all", "top", 5, "top",
    )
    return found.comments.select("id", "post_id", "score")


# Search --------------------------------------------------------------------------

QUERY = "The information: en thereed!"
TERMS = ("information", "en", "thereed")


def bm25_sql(rank: str = "relevance", limit: int = 50, table: str = "documents") -> str:
    tf = ", ".join(
        f"CAST(len(list_filter(ws, lambda w: w = '{t}')) AS DOUBLE) AS tf{i}" for i, t in enumerate(TERMS)
    )
    seen = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(TERMS)))
    weight = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * len_ / mean))"
        for i in range(len(TERMS))
    )
    some = " OR ".join(f"tf{i} > 0" for i in range(len(TERMS)))
    return f"""WITH words AS (SELECT doc_id, n_chars, {tokens_sql("source || ' ' || text")} AS ws FROM {table}),
    counted AS (SELECT doc_id, n_chars, len(ws) AS len_, {tf} FROM words),
    figures AS (SELECT count(*) AS n, avg(len_) AS mean, {seen} FROM counted),
    scored AS (SELECT doc_id, n_chars, {weight} AS relevance FROM counted, figures WHERE {some})
    SELECT doc_id, round(relevance, 6) AS relevance FROM scored ORDER BY {rank} DESC, doc_id LIMIT {limit}"""


def document_search(spark, folder, sort_by):
    docs = spread(load(spark, folder, "documents").select("doc_id", "source", "text", "n_chars"))
    found = search(
        docs, QUERY, 50, sort_by, fields=["source", "text"], key="doc_id", created="doc_id", score="n_chars",
        comments="n_chars",
    )
    return found.select("doc_id", F.round("relevance", 6).alias("relevance"))


@check("search_bm25", bm25_sql())
def search_relevance(spark, folder):
    return document_search(spark, folder, "relevance")


@check("search_top", bm25_sql("n_chars"))
def search_top(spark, folder):
    return document_search(spark, folder, "top")


def indexed(spark, folder, label):
    docs = load(spark, folder, "documents")
    schemas = {"documents": schema_of(docs, "doc_id")}
    store = Store(spark, "table", work_path(spark, label), "doc_id", schemas, search={"documents": ["source", "text"]})
    store.save("documents", docs, order_by=None)
    return store, docs


def stored_search(store, **options):
    found = store.search("documents", QUERY, 50, created="doc_id", score="n_chars", comments="n_chars", **options)
    return found.select("doc_id", F.round("relevance", 6).alias("relevance"))


@check("search_index", bm25_sql())
def search_index(spark, folder):
    """The best posts from stored postings; blocks that cannot hold one are skipped."""
    store, _ = indexed(spark, folder, "indexed")
    return stored_search(store)


@check("search_index_top", bm25_sql("n_chars"))
def search_index_top(spark, folder):
    """All matches from stored postings, in another order."""
    store, _ = indexed(spark, folder, "indexed-top")
    return stored_search(store, sort_by="top")


@check(
    "search_index_upsert",
    "WITH changed AS (SELECT doc_id, n_chars, source, CASE doc_id % 3 WHEN 0 THEN 'information ' || lang WHEN 1 THEN text || ' thereed' ELSE text END AS text FROM documents), "
    + bm25_sql(table="changed").removeprefix("WITH "),
)
def search_index_upsert(spark, folder):
    """Two batches replace two thirds of the posts; the postings follow, and replaced texts are no longer found or counted."""
    store, docs = indexed(spark, folder, "indexed-upsert")
    third = lambda n: F.col("doc_id") % 3 == n
    store.save("documents", docs.where(third(1)).withColumn("text", F.concat("text", F.lit(" gone thereed"))), order_by=None)
    new = F.when(third(0), F.concat(F.lit("information "), "lang")).otherwise(F.concat("text", F.lit(" thereed")))
    store.save("documents", docs.where(~third(2)).withColumn("text", new), order_by=None)
    return stored_search(store)
