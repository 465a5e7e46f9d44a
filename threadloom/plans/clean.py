"""Cleaning plans for posts and comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..functions.text import TextOptions
from ..operators.dedup import keep_last
from ..operators.filters import Moment, by_date, by_score
from ..operators.metrics import StepMetrics
from ..operators.transforms import clean_fields


def clean_rows(
    df: DataFrame,
    text_fields: Sequence[str],
    remove_duplicates: bool = True,
    min_score: float | None = None,
    start_date: Moment | None = None,
    end_date: Moment | None = None,
    options: TextOptions | None = None,
    key: str = "id",
    order_by: Sequence[str | Column] = ("created_utc",),
    unique_order: bool = False,
    score: str = "score",
    created: str = "created_utc",
    lemmas: DataFrame | None = None,
    metrics: StepMetrics | None = None,
) -> DataFrame:
    """Deduplicate, filter by date, filter by score, clean texts, in this order.

    The order matters: the last copy of a row is chosen first and may then be
    filtered out, so the filters must not be moved below the deduplication.
    """

    def step(rows: DataFrame, name: str) -> DataFrame:
        return metrics.counted(rows, name) if metrics else rows

    df = step(df, "input")
    if remove_duplicates:
        df = step(keep_last(df, key, order_by, unique_order), "deduplicated")
    if start_date is not None or end_date is not None:
        df = step(by_date(df, created, start_date, end_date), "date")
    if min_score is not None:
        df = step(by_score(df, score, min_score), "score")
    return clean_fields(df, text_fields, options, lemmas) if text_fields else df


def clean_posts(
    posts: DataFrame, clean_title: bool = True, clean_selftext: bool = True, **settings
) -> DataFrame:
    """Clean posts; ``settings`` are those of :func:`clean_rows`."""
    chosen = {"title": clean_title, "selftext": clean_selftext}
    return clean_rows(posts, [f for f, on in chosen.items() if on], **settings)


def clean_comments(comments: DataFrame, clean_body: bool = True, **settings) -> DataFrame:
    """Clean comments; ``settings`` are those of :func:`clean_rows`."""
    return clean_rows(comments, ["body"] if clean_body else [], **settings)
