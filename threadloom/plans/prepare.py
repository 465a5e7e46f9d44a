"""Plans that prepare cleaned data for analysis."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.features import comment_features, post_features
from ..operators.sets import corpus
from ..schemas import COMMENTS, POSTS, conform


@dataclass(frozen=True)
class Prepared:
    """Both tables with their texts and the combined corpus."""

    posts: DataFrame
    comments: DataFrame
    post_texts: DataFrame
    comment_texts: DataFrame
    all_texts: DataFrame


def prepare_for_analysis(posts: DataFrame, comments: DataFrame) -> dict[str, DataFrame]:
    """Both tables with exactly the stored columns and types."""
    return {"posts": conform(posts, POSTS), "comments": conform(comments, COMMENTS)}


def prepare_for_ml(
    posts: DataFrame,
    comments: DataFrame,
    post_text_field: str = "selftext",
    comment_text_field: str = "body",
    post_key: str = "id",
    comment_key: str = "id",
) -> Prepared:
    """Texts per kind and together, null as empty text; empty tables give empty texts."""
    post_part = ("post", posts, post_key, post_text_field)
    comment_part = ("comment", comments, comment_key, comment_text_field)
    return Prepared(
        posts,
        comments,
        corpus(post_part),
        corpus(comment_part),
        corpus(post_part, comment_part),
    )


def extract_features(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One row with the structs ``post_features`` and ``comment_features``."""
    left, right = post_features(posts), comment_features(comments)
    packed = right.select(F.struct(*right.columns).alias("comment_features"))
    return left.select(F.struct(*left.columns).alias("post_features")).withColumn(
        "comment_features", packed.scalar()
    )
