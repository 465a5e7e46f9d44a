"""Full-text search over posts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.text import TextOptions, tokens
from ..session import cut_lineage
from .rank import RANK, post_rank, top_rows, within

SEARCH_ORDERS = ("relevance", "hot", "top", "new", "comments")
RELEVANCE = "relevance"


def query_terms(spark: SparkSession, query: str, options: TextOptions) -> list[str]:
    """The distinct terms of a query, cleaned like the texts (constant-folded, no job)."""
    row = spark.sql("SELECT 1").select(F.array_distinct(tokens(F.lit(query), options))).first()
    return list(row[0])


def bm25(
    posts: DataFrame,
    query: str,
    fields: Sequence[str] = ("title", "selftext"),
    options: TextOptions | None = None,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """Posts that hold a query term, with their BM25 ``relevance``.

    ``idf(t) = ln(1 + (N - n_t + 0.5) / (n_t + 0.5))`` and the term weight is
    ``tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / average length))``.

    One pass over the texts: term counts are computed per row, so no word is
    shuffled; the corpus figures are observed on the way, and the rows that hold
    a term are checkpointed with their counts and scored from there.
    """
    options = options or TextOptions()
    terms = query_terms(posts.sparkSession, query, options)
    if not terms:
        return posts.where(F.lit(False)).withColumn(RELEVANCE, F.lit(0.0))
    text = F.concat_ws(" ", *[F.col(f) for f in fields])
    words = posts.select("*", tokens(text, options).alias("_words"))
    hits = F.filter("_words", lambda w: w.isin(terms))
    sized = words.select(*posts.columns, F.size("_words").alias("_length"), hits.alias("_hits"))
    counted = sized.select(*posts.columns, "_length", *[_times("_hits", t).alias(f"_tf{i}") for i, t in enumerate(terms)])
    corpus = Observation()
    measures = [
        F.count("*").alias("n"),
        F.avg("_length").alias("mean"),
        *[F.count(F.when(F.col(f"_tf{i}") > 0, True)).alias(f"df{i}") for i in range(len(terms))],
    ]
    # Observing keeps the filter above it, so every text is tokenised once.
    any_term = reduce(or_, [F.col(f"_tf{i}") > 0 for i in range(len(terms))])
    found = cut_lineage(counted.observe(corpus, *measures).where(any_term))
    figures = corpus.get
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("_length") / F.lit(figures["mean"]))
    total = F.lit(0.0)
    for i in range(len(terms)):
        seen = F.lit(float(figures[f"df{i}"]))
        idf = F.log(F.lit(1.0) + (F.lit(float(figures["n"])) - seen + F.lit(0.5)) / (seen + F.lit(0.5)))
        tf = F.col(f"_tf{i}").cast("double")
        total = total + idf * tf * F.lit(k1 + 1) / (tf + norm)
    return found.withColumn(RELEVANCE, total).select(*posts.columns, RELEVANCE)


def _times(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == F.lit(term)))


def search(
    posts: DataFrame,
    query: str,
    limit: int | None = 100,
    sort_by: str = "relevance",
    time_filter: str = "all",
    as_of: dt.datetime | None = None,
    fields: Sequence[str] = ("title", "selftext"),
    key: str = "id",
    created: str = "created_utc",
    comments: str = "num_comments",
    options: TextOptions | None = None,
    **columns,
) -> DataFrame:
    """The first ``limit`` posts that match a query, in the chosen order.

    The time window applies to every order.  Corpus figures are taken over the
    posts inside the window.
    """
    if sort_by not in SEARCH_ORDERS:
        raise ValueError(f"sort_by cannot be {sort_by!r}; choose from {', '.join(SEARCH_ORDERS)}")
    posts = within(posts, time_filter, as_of, created)
    matches = bm25(posts, query, fields, options)
    if sort_by == "relevance":
        rank = F.col(RELEVANCE)
    elif sort_by == "comments":
        rank = F.col(comments)
    else:
        rank = post_rank(matches, sort_by, as_of, created=created, **columns)
    return top_rows(matches, rank, key, limit)


__all__ = ["RANK", "RELEVANCE", "SEARCH_ORDERS", "bm25", "query_terms", "search"]
