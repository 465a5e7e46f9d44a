"""Normalisation of raw collector records to the stored schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import epoch_to_timestamp, or_default, part
from ..schemas import COMMENTS, COMMUNITY, POSTS, conform

# Fixed value: the author shown for a deleted account.
DELETED = "[deleted]"


def normalize_posts(raw: DataFrame) -> DataFrame:
    """Raw posts as stored posts: flair renamed, null author and epoch time resolved."""
    return conform(
        raw.withColumns(
            {
                "author": or_default(F.col("author"), DELETED),
                "created_utc": epoch_to_timestamp(F.col("created_utc")),
                "flair": F.col("link_flair_text"),
            }
        ),
        POSTS,
    )


def bare_parent(parent_id: Column) -> Column:
    """The parent id without its kind prefix; null when there is no prefix."""
    return part(parent_id, "_", 1)


def normalize_comments(raw: DataFrame, post_id: Column | str | None = None) -> DataFrame:
    """Raw comments as stored comments.

    ``post_id`` names the post the comments were fetched for; without it the
    raw frame must have the column.
    """
    if post_id is not None:
        raw = raw.withColumn("post_id", F.lit(post_id) if isinstance(post_id, str) else post_id)
    return conform(
        raw.withColumns(
            {
                "parent_id": bare_parent(F.col("parent_id")),
                "author": or_default(F.col("author"), DELETED),
                "created_utc": epoch_to_timestamp(F.col("created_utc")),
            }
        ),
        COMMENTS,
    )


def normalize_community(raw: DataFrame) -> DataFrame:
    """Raw community descriptions with the display name and creation time resolved."""
    return conform(
        raw.withColumns(
            {
                "name": F.col("display_name"),
                "created_utc": epoch_to_timestamp(F.col("created_utc")),
            }
        ),
        COMMUNITY,
    )
