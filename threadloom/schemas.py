"""Table schemas of the discussion data model.

A store holds ``posts`` and ``comments``; ``COMMUNITY`` describes the
community a crawl belongs to.  The ``RAW_*`` schemas are the shapes delivered
by a collector before normalisation: epoch seconds instead of timestamps and
authors that may be missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _I, _D, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)

# Column names and types of the stored tables.
POSTS = _struct(
    ("id", _S, False),
    ("title", _S, False),
    ("author", _S, False),
    ("created_utc", _TS, False),
    ("score", _I, False),
    ("upvote_ratio", _D, True),
    ("num_comments", _I, False),
    ("url", _S, False),
    ("selftext", _S, True),
    ("is_self", _B, False),
    ("permalink", _S, False),
    ("flair", _S, True),
    ("domain", _S, True),
    ("is_video", _B, True),
    ("is_original_content", _B, True),
    ("subreddit", _S, False),
)

COMMENTS = _struct(
    ("id", _S, False),
    ("post_id", _S, False),
    ("parent_id", _S, False),
    ("author", _S, False),
    ("created_utc", _TS, False),
    ("score", _I, False),
    ("body", _S, False),
    ("permalink", _S, True),
    ("depth", _I, True),
    ("is_submitter", _B, True),
    ("subreddit", _S, False),
)

COMMUNITY = _struct(
    ("id", _S, False),
    ("name", _S, False),
    ("title", _S, True),
    ("description", _S, True),
    ("public_description", _S, True),
    ("subscribers", _I, True),
    ("created_utc", _TS, False),
    ("over18", _B, True),
    ("url", _S, True),
)

TABLES = {"posts": POSTS, "comments": COMMENTS}


def required(schema: T.StructType) -> list[str]:
    """Names of the columns a stored row must have a value for."""
    return [f.name for f in schema if not f.nullable]


def relaxed(schema: T.StructType) -> T.StructType:
    """The same schema with every column nullable, as file readers need it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of ``schema``.

    An absent nullable column becomes null; an absent required column is an
    error, because inventing a value for it would hide a broken source.
    """
    missing = [n for n in required(schema) if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
