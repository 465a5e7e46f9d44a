"""Summary features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from .rank import first_per_group
from .transforms import optional


def share(flag: Column) -> Column:
    """Mean of a boolean: the share of true among the known values."""
    return F.avg(flag.cast("int"))


def top_values(
    df: DataFrame, column: str, n: int = 10, by: Sequence[str] = (), count: str = "count"
) -> DataFrame:
    """The ``n`` most frequent values, overall or per group; nulls are not counted.

    Counts are combined before the shuffle, so a dominant value costs one row
    per task.  Equal counts are ordered by value.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, column)
        .agg(F.count("*").alias(count))
    )
    order = [F.col(count).desc(), F.col(column).asc()]
    if not by:
        return counts.orderBy(*order).limit(n)
    # The counts are dealt by group and value; a group may have very many values.
    return first_per_group(counts, by, order, n)


def _as_list(top: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    # At most n items per group reach this array.
    item = F.struct((-F.col("count")).alias("order"), F.col(column).alias("value"))
    listed = F.transform(
        F.sort_array(F.collect_list(item)),
        lambda x: F.struct(x["value"].alias("value"), (-x["order"]).alias("count")),
    )
    grouped = top.groupBy(*by) if by else top.groupBy()
    return grouped.agg(listed.alias(name))


def post_features(posts: DataFrame, by: Sequence[str] = (), top: int = 10) -> DataFrame:
    """Score, activity and source features of posts, overall or per ``by`` group.

    An empty table gives one row with count 0 and nulls.  ``is_self`` and
    ``domain`` may be absent; their features are null then.
    """
    measures = [
        F.avg("score").alias("avg_score"),
        F.max("score").alias("max_score"),
        F.avg("num_comments").alias("avg_comments"),
        F.count("*").alias("total_posts"),
        share(optional(posts, "is_self", "boolean")).alias("self_post_ratio"),
    ]
    features = posts.groupBy(*by).agg(*measures)
    if "domain" not in posts.columns:
        return features.withColumn(
            "top_domains", F.lit(None).cast("array<struct<value:string,count:bigint>>")
        )
    domains = _as_list(top_values(posts, "domain", top, by), "domain", by, "top_domains")
    if by:
        # Null-safe: the group without a value has domains too.
        named = domains.toDF(*[f"_by_{c}" if c in by else c for c in domains.columns])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
        return features.join(named, same, "left").select(*features.columns, "top_domains")
    # One row each: a scalar subquery adds the list without a join.
    return features.withColumn("top_domains", domains.scalar())


def comment_features(comments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Score and depth features of comments, overall or per ``by`` group."""
    return comments.groupBy(*by).agg(
        F.avg("score").alias("avg_score"),
        F.max("score").alias("max_score"),
        F.count("*").alias("total_comments"),
        F.avg(optional(comments, "depth", "int")).alias("avg_depth"),
    )
