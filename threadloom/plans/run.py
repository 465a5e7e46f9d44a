"""The whole job: select, clean if asked, upsert, verify."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..functions.text import TextOptions
from ..operators.rank import RANK, listing
from ..session import cut_lineage, drop_path, size_shuffles, work_path
from ..sources.files import write_files
from ..sources.normalize import normalize_comments, normalize_posts
from ..sources.store import Store, reconcile
from .clean import clean_comments, clean_posts
from .collect import comments_of


def run(
    raw_posts: DataFrame,
    raw_comments: DataFrame,
    store: Store,
    limit: int | None = 10,
    sort_by: str = "hot",
    time_filter: str = "week",
    min_score: float | None = None,
    clean_text: bool = False,
    as_of: dt.datetime | None = None,
    order_by: Sequence[str | Column] = ("created_utc",),
) -> dict[str, DataFrame]:
    """Normalise raw records, clean them if asked, save both tables, compare.

    With neither ``min_score`` nor ``clean_text`` the rows are stored as they
    are; the store still keeps one row per key.  The batch is written to the
    shared folder once, so that saving and verifying read the same rows instead
    of computing them twice, and deleted at the end.  The result maps each table to a one-row
    reconciliation of the batch against the store.
    """
    spark = store.spark
    size_shuffles(raw_posts, raw_comments)
    # The listing is computed once; the comments are joined to its copy.
    listed = _kept(spark, listing(normalize_posts(raw_posts), sort_by, time_filter, limit, as_of, ordered=False).drop(RANK))
    posts = spark.read.parquet(listed)
    comments = comments_of(posts, normalize_comments(raw_comments), ordered=False)
    cleaned = min_score is not None or clean_text
    if cleaned:
        shared = {
            "min_score": min_score,
            "options": TextOptions.switched(clean_text),
            "order_by": order_by,
        }
        posts = clean_posts(posts, clean_text, clean_text, **shared)
        comments = clean_comments(comments, clean_text, **shared)
    report = {}
    copies = [listed]
    for table, rows in (("posts", posts), ("comments", comments)):
        copies.append(_kept(spark, rows))
        batch = spark.read.parquet(copies[-1])
        # Cleaning has left one row per key already.
        store.save(table, batch, order_by=None if cleaned else order_by)
        report[table] = cut_lineage(reconcile(batch, store.read(table), store.key))
    for path in copies:
        drop_path(spark, path)
    return report


def _kept(spark: SparkSession, rows: DataFrame) -> str:
    path = work_path(spark, "run")
    write_files(rows, "parquet", path)
    return path
