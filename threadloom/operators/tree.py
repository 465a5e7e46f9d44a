"""Comment trees stored as parent links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..session import cut_lineage
from .dedup import _hashable
from .position import number_rows


def roots(comments: DataFrame, parent: str = "parent_id", post: str = "post_id") -> DataFrame:
    """Top-level comments: their parent is the post itself."""
    return comments.where(F.col(parent) == F.col(post))


def walk(
    comments: DataFrame,
    key: str = "id",
    parent: str = "parent_id",
    post: str = "post_id",
    sibling_order: str | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Comments reachable from a post, with ``root_id`` and ``walk_depth``.

    Roots have depth 0.  Replies whose chain of parents never reaches a root
    (a missing parent, a cycle) are not part of the walk.  Of several rows with
    one id the least parent counts for all, and each row appears once.

    ``order`` (sort columns, as from ``comment_order``) adds ``walk_position``:
    the number of the comment in its post from 1, in breadth-first order, where
    roots follow ``order`` and replies follow their parent's place, then
    ``order``.  See :func:`positions`.

    ``sibling_order`` names one column to order siblings by, ascending, and adds
    ``walk_path``, the sibling keys from the root down.  Paths are as long as a
    thread is deep; prefer ``order`` where threads may be deep.

    Links are followed by pointer doubling: round ``k`` settles the depths up
    to ``2^k``, so a thread of depth ``d`` takes about ``log2(d)`` joins
    instead of ``d``.  Rounds work on the link columns only and are written to
    the shared checkpoint folder.  A parent with very many replies repeats on
    one side of the join only, which adaptive execution can split.
    """
    value = [F.col(sibling_order).alias("value")] if sibling_order else []
    one = (
        comments.where(F.col(key).isNotNull() & F.col(parent).isNotNull())
        .groupBy(F.col(post).alias("post"), F.col(key).alias("node"))
        .agg(F.min(F.struct(F.col(parent).alias("parent"), *value)).alias("l"))
    )
    is_root = F.col("l.parent") == F.col("post")
    own = F.array(F.struct(F.col("l.value").alias(sibling_order), F.col("node").alias(key))) if sibling_order else None
    links = one.select(
        "post",
        "node",
        is_root.alias("settled"),
        # The ancestor reached so far; a root points at itself.
        F.when(is_root, F.col("node")).otherwise(F.col("l.parent")).alias("link"),
        F.when(is_root, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("depth"),
        *([own.alias("path")] if sibling_order else []),
    )
    state = cut_lineage(links)
    open_rows = None
    while True:
        target = state.select(
            F.col("post").alias("t_post"),
            F.col("node").alias("t_node"),
            F.col("link").alias("t_link"),
            F.col("settled").alias("t_settled"),
            F.col("depth").alias("t_depth"),
            *([F.col("path").alias("t_path")] if sibling_order else []),
        )
        unsettled = state.where(~F.col("settled"))
        # An inner join drops replies whose ancestor does not exist.
        moved = unsettled.join(
            target,
            (F.col("post") == F.col("t_post")) & (F.col("link") == F.col("t_node")),
        ).select(
            "post",
            "node",
            F.col("t_settled").alias("settled"),
            F.col("t_link").alias("link"),
            (F.col("depth") + F.col("t_depth")).alias("depth"),
            *([F.concat("t_path", "path").alias("path")] if sibling_order else []),
        )
        count = Observation()
        state = cut_lineage(
            state.where(F.col("settled"))
            .unionByName(moved)
            .observe(count, F.count(F.when(~F.col("settled"), True)).alias("open"))
        )
        still_open = count.get["open"]
        # While any open chain ends at a root, every round settles at least one
        # row.  No progress therefore means that only cycles are left.
        if still_open == 0 or still_open == open_rows:
            break
        open_rows = still_open
    reached = state.where(F.col("settled")).select(
        F.col("post").alias(post),
        F.col("node").alias(key),
        F.col("link").alias("root_id"),
        F.col("depth").alias("walk_depth"),
        *([F.col("path").alias("walk_path")] if sibling_order else []),
    )
    walked = comments.join(reached, [post, key])
    return walked if order is None else positions(walked, order, key, parent, post)


def positions(
    walked: DataFrame,
    order: Sequence[Column],
    key: str = "id",
    parent: str = "parent_id",
    post: str = "post_id",
    name: str = "walk_position",
) -> DataFrame:
    """Walked comments (see :func:`walk`) with their breadth-first number in the post.

    Siblings are numbered by ``order``.  A comment's place in its level is the
    order of the sibling numbers from the root down, which doubling finds
    without paths: round k combines the rank over the nearest ``2^k`` ancestors
    with that of the ancestor ``2^k`` above, and ranks these pairs of longs in
    each level anew.  All numbering goes by range pieces, so a hot post or a hot
    level is never in one task.
    """
    # Of rows that repeat an id the one with the least parent counts, as for the walk.
    plain = [F.col(f"`{f.name}`") for f in walked.schema if _hashable(f.dataType)]
    first = Window.partitionBy(post, key).orderBy(F.col(parent), *order, F.xxhash64(*plain))
    one = walked.withColumn("_first", F.row_number().over(first)).where("_first = 1").drop("_first")
    numbered = number_rows(one, [post, parent], order, "_rank")
    state = cut_lineage(
        numbered.select(
            F.col(post).alias("post"),
            F.col(key).alias("node"),
            F.when(F.col(parent) != F.col(post), F.col(parent)).alias("link"),
            F.col("walk_depth").alias("depth"),
            F.col("_rank").alias("rank"),
        )
    )
    deepest = state.agg(F.max("depth")).first()[0] or 0
    span = 1
    while span <= deepest:
        above = state.select(
            F.col("post").alias("a_post"), F.col("node").alias("a_node"), F.col("link").alias("a_link"), F.col("rank").alias("a_rank")
        )
        same = (F.col("post") == F.col("a_post")) & (F.col("link") == F.col("a_node"))
        joined = cut_lineage(
            state.join(above, same, "left").select(
                "post", "node", F.col("a_link").alias("link"), "depth", F.coalesce("a_rank", F.lit(0)).alias("high"), F.col("rank").alias("low")
            )
        )
        pair = ["post", "depth", "high", "low"]
        ranked = number_rows(joined.select(*pair).distinct(), pair[:2], [F.col("high"), F.col("low")], "rank")
        state = cut_lineage(joined.join(ranked, pair).select("post", "node", "link", "depth", "rank"))
        span *= 2
    placed = number_rows(state.select("post", "node", "depth", "rank"), ["post"], [F.col("depth"), F.col("rank")], name)
    return walked.join(placed.select(F.col("post").alias(post), F.col("node").alias(key), name), [post, key])
