"""The posts of a listing together with their comments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.rank import RANK, comment_listing, comment_order, listing
from ..operators.sizing import fits_broadcast
from ..operators.tree import walk


@dataclass(frozen=True)
class Discussion:
    """Posts and the comments that belong to them."""

    posts: DataFrame
    comments: DataFrame


def posts_with_comments(
    posts: DataFrame,
    comments: DataFrame,
    limit: int | None = 10,
    time_filter: str = "week",
    sort_by: str = "hot",
    comment_limit: int | None = None,
    comment_sort: str = "best",
    as_of: dt.datetime | None = None,
    ordered: bool = True,
    nested: bool = False,
) -> Discussion:
    """A listing of posts and, per listed post, its comments in listing order.

    ``ordered=False`` keeps the choice of rows but promises no order.  With
    ``nested`` the comments come in walk order: the sorted top level first, then
    the replies level by level; comments that no post is reached from are left
    out and ``walk_position`` is added.
    """
    listed = listing(posts, sort_by, time_filter, limit, as_of, ordered=ordered).drop(RANK)
    return Discussion(listed, comments_of(listed, comments, comment_limit, comment_sort, ordered, nested))


def comments_of(
    listed: DataFrame,
    comments: DataFrame,
    comment_limit: int | None = None,
    comment_sort: str = "best",
    ordered: bool = True,
    nested: bool = False,
) -> DataFrame:
    """The comments of listed posts, as :func:`posts_with_comments` returns them."""
    keys = listed.select(F.col("id").alias("post_id"))
    own = comments.join(keys, "post_id", "left_semi")
    if nested:
        walked = walk(own, order=comment_order(comment_sort))
        if comment_limit is not None:
            walked = walked.where(F.col("walk_position") <= comment_limit)
        return walked.orderBy("post_id", "walk_position") if ordered else walked
    # Beyond the broadcast threshold the join deals the comments by post.
    dealt = not fits_broadcast(keys)
    return comment_listing(own, comment_sort, comment_limit, ordered=ordered, dealt_by_post=dealt)
