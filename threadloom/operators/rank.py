"""Ranked listings of posts and of the comments of each post."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ranking
from ..functions.scalars import time_literal
from .position import number_rows

POST_ORDERS = ("hot", "new", "top", "rising", "controversial")
COMMENT_ORDERS = ("best", "top", "new", "controversial", "old", "qa")
# Names of the time windows; a month is 30 days, a year 365.
TIME_WINDOWS = {
    "hour": dt.timedelta(hours=1),
    "day": dt.timedelta(days=1),
    "week": dt.timedelta(days=7),
    "month": dt.timedelta(days=30),
    "year": dt.timedelta(days=365),
    "all": None,
}
RANK = "rank_value"


def _choice(value: str, allowed: tuple[str, ...] | dict, what: str) -> str:
    if value not in allowed:
        raise ValueError(f"{what} cannot be {value!r}; choose from {', '.join(allowed)}")
    return value


def within(
    df: DataFrame,
    time_filter: str,
    as_of: dt.datetime | None = None,
    created: str = "created_utc",
) -> DataFrame:
    """Rows created in the named window before ``as_of`` (default: now)."""
    span = TIME_WINDOWS[_choice(time_filter, TIME_WINDOWS, "time_filter")]
    if span is None:
        return df
    if as_of is not None:
        # A literal bound reaches the Parquet scan.
        since = time_literal(as_of - span, df.schema[created].dataType)
    else:
        since = F.current_timestamp() - F.lit(span)
    return df.where(F.col(created) >= since)


def post_rank(
    df: DataFrame,
    sort_by: str,
    as_of: dt.datetime | None = None,
    score: str = "score",
    created: str = "created_utc",
    ratio: str = "upvote_ratio",
    decay: float = 45_000.0,
    gravity: float = 1.8,
) -> Column:
    """The value posts are ranked by, greatest first."""
    _choice(sort_by, POST_ORDERS, "sort_by")
    s, t = F.col(score), F.col(created)
    if sort_by == "new":
        return t
    if sort_by == "top":
        return s
    if sort_by == "hot":
        return ranking.hot(s, t, decay)
    if sort_by == "rising":
        now = time_literal(as_of) if as_of is not None else F.current_timestamp()
        return ranking.rising(s, t, now, gravity)
    return ranking.controversial(*ranking.votes(s, F.col(ratio)))


def top_rows(
    df: DataFrame, rank: Column, key: str = "id", limit: int | None = None, ordered: bool = True
) -> DataFrame:
    """Rows by rank, greatest first, equal ranks by key; with a limit no full sort happens."""
    ranked = df.withColumn(RANK, rank)
    if limit is None and not ordered:
        return ranked
    ranked = ranked.orderBy(F.col(RANK).desc_nulls_last(), F.col(key).asc())
    return ranked if limit is None else ranked.limit(limit)


def _beyond(rank: Column, key: Column, mark: tuple, behind: bool) -> Column:
    """Rows behind (or ahead of) a mark in the order of ``top_rows``, unknown ranks last."""
    value, last = mark
    beside = key > F.lit(last) if behind else key < F.lit(last)
    if value is None:
        return rank.isNull() & beside if behind else rank.isNotNull() | beside
    further = (rank < F.lit(value)) | rank.isNull() if behind else rank > F.lit(value)
    return further | ((rank == F.lit(value)) & beside)


def listing(
    posts: DataFrame,
    sort_by: str = "hot",
    time_filter: str = "week",
    limit: int | None = 100,
    as_of: dt.datetime | None = None,
    key: str = "id",
    created: str = "created_utc",
    after: tuple | None = None,
    before: tuple | None = None,
    ordered: bool = True,
    **columns,
) -> DataFrame:
    """The first ``limit`` posts of a ranking.

    The time window applies to ``top`` and ``controversial`` only.  ``after``
    and ``before`` are ``(rank value, key)`` pairs of a row seen earlier and
    select the page right behind or right ahead of it; the value is None for a
    row of unknown rank, which comes last.
    """
    _choice(time_filter, TIME_WINDOWS, "time_filter")
    rank = post_rank(posts, sort_by, as_of, created=created, **columns)
    if sort_by in ("top", "controversial"):
        posts = within(posts, time_filter, as_of, created)
    for bound, behind in ((after, True), (before, False)):
        if bound is not None:
            posts = posts.where(_beyond(rank, F.col(key), bound, behind))
    if before is not None and after is None and limit is not None:
        # The page that ends at the mark: its rows come first in reverse order.
        back = posts.withColumn(RANK, rank).orderBy(F.col(RANK).asc_nulls_first(), F.col(key).desc())
        posts = back.limit(limit).drop(RANK)
    return top_rows(posts, rank, key, limit, ordered)


def comment_order(
    sort_by: str = "best",
    score: str = "score",
    created: str = "created_utc",
    submitter: str = "is_submitter",
    key: str = "id",
) -> list[Column]:
    """Sort columns for comments.

    Comments have no upvote ratio, so ``best`` is the score and
    ``controversial`` the smallest absolute score.
    """
    _choice(sort_by, COMMENT_ORDERS, "sort_by")
    by_score = F.col(score).desc_nulls_last()
    orders = {
        "best": [by_score],
        "top": [by_score],
        "new": [F.col(created).desc_nulls_last()],
        "old": [F.col(created).asc_nulls_last()],
        "controversial": [F.abs(F.col(score)).asc_nulls_last()],
        "qa": [F.col(submitter).desc_nulls_last(), by_score],
    }
    return [*orders[sort_by], F.col(key).asc()]


def first_per_group(
    df: DataFrame, group: str | Sequence[str], order: list[Column], limit: int, dealt_by_group: bool = False
) -> DataFrame:
    """The first ``limit`` rows of every group.

    Spark trims each group inside its input partitions before the shuffle as
    long as the limit is within ``spark.sql.optimizer.windowGroupLimitThreshold``.
    Larger limits number the rows by range pieces (see ``number_rows``).  Rows
    that a shuffled join has already dealt by group cannot be trimmed before a
    shuffle; with ``dealt_by_group`` they are dealt anew over slices of the
    groups, trimmed there, and then per group.  The rows are the same in every
    case, and no task sorts a whole hot group.
    """
    groups = [group] if isinstance(group, str) else list(group)
    spark = df.sparkSession
    if limit > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return number_rows(df, groups, order, "_rn").where(F.col("_rn") <= limit).drop("_rn")
    if dealt_by_group:
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The place of a row in its task spreads a group whatever its values are.
        sliced = df.withColumn("_slice", F.pmod(F.monotonically_increasing_id(), F.lit(slices)))
        sliced = sliced.repartition(*groups, "_slice")
        local = Window.partitionBy(*groups, "_slice").orderBy(*order)
        df = sliced.withColumn("_rn", F.row_number().over(local)).where(F.col("_rn") <= limit).drop("_rn", "_slice")
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= limit).drop("_rn")


def comment_listing(
    comments: DataFrame,
    sort_by: str = "best",
    limit: int | None = None,
    post: str = "post_id",
    ordered: bool = True,
    dealt_by_post: bool = False,
    **columns,
) -> DataFrame:
    """Comments in listing order per post, at most ``limit`` of each post.

    Without a limit this is a sort on (post, rank): range partitioning can cut
    through one hot post, which a window per post could not.  A caller that
    does not need the order, only the choice of rows, saves the sort with
    ``ordered=False``.  ``dealt_by_post`` says that the comments come out of a
    shuffled join on the post (see :func:`first_per_group`).
    """
    order = comment_order(sort_by, **columns)
    if limit is not None:
        comments = first_per_group(comments, post, order, limit, dealt_by_post)
    return comments.orderBy(F.col(post), *order) if ordered else comments
