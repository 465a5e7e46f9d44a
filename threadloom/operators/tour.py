"""Measures of subtrees by an Euler tour of every thread."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .position import number_rows
from .sizing import dealt_anew


def _ranked(arcs: DataFrame) -> DataFrame:
    """``(arc, left, sum)``: how many arcs follow to the end of the list, itself included, and the sum of their weights.

    ``arcs`` are (arc, next, weight), next null at the end of a list.  Pointer
    doubling: each round joins every arc with the one its pointer has reached,
    so a list of n arcs takes log2(n) rounds.  Arcs that have reached the end
    are set aside and only looked up.
    """
    now = cut_lineage(arcs.select("arc", "next", F.lit(1).cast("long").alias("left"), F.col("weight").alias("sum")))
    while not now.where(F.col("next").isNotNull()).isEmpty():
        ahead = now.select(
            dealt_anew(now, "arc").alias("_arc"), F.col("next").alias("_next"), F.col("left").alias("_left"), F.col("sum").alias("_sum")
        )
        open_ = now.where(F.col("next").isNotNull()).join(ahead, F.col("next") == F.col("_arc"))
        moved = open_.select("arc", F.col("_next").alias("next"), (F.col("left") + F.col("_left")).alias("left"), (F.col("sum") + F.col("_sum")).alias("sum"))
        now = cut_lineage(now.where(F.col("next").isNull()).unionByName(moved))
    return now.select("arc", "left", "sum")


def subtree_measures(
    walked: DataFrame, score: str = "score", key: str = "id", parent: str = "parent_id", post: str = "post_id"
) -> DataFrame:
    """Walked comments (see ``tree.walk``) with ``enter``, ``leave``, ``subtree_size`` and ``subtree_score``.

    The tour of a thread goes down into every reply and back up; ``enter`` and
    ``leave`` are the steps at which it comes to a comment and leaves it, from 0
    in every post, siblings by their key.  A comment is above another one of
    its post if it enters before and leaves after it (``is_above``), so ancestor
    questions are range joins without paths.  Size and score count the comment
    itself; a null score counts as 0.

    The tour is a linked list over two arcs per comment, numbered by pointer
    doubling: a thread of any depth or width takes log2 of its length rounds of
    joins over longs.  Of repeated rows of an id one carries the score, the
    least; all of them get the measures.
    """
    one = (
        walked.groupBy(F.col(post).alias("post"), F.col(key).alias("node"))
        .agg(F.min(parent).alias("parent"), F.min(F.coalesce(F.col(score), F.lit(0)).cast("long")).alias("score"))
    )
    named = cut_lineage(one.withColumn("n", F.monotonically_increasing_id()))
    places = named.select(F.col("post").alias("_post"), F.col("node").alias("_node"), F.col("n").alias("up"))
    linked = named.join(places, (F.col("post") == F.col("_post")) & (F.col("parent") == F.col("_node")), "left").select(
        "post", "node", "n", "score", F.when(F.col("parent") != F.col("post"), F.col("up")).alias("up")
    )
    siblings = cut_lineage(number_rows(linked, ["post", "up"], [F.col("node")], "place"))
    after = siblings.select(F.col("post").alias("_post"), F.col("up").alias("_up"), (F.col("place") - 1).alias("_place"), F.col("n").alias("following"))
    same = (F.col("post") == F.col("_post")) & F.col("up").eqNullSafe(F.col("_up")) & (F.col("place") == F.col("_place"))
    with_next = siblings.join(after, same, "left").select("n", "up", "score", "following")
    first = siblings.where("place = 1 AND up IS NOT NULL").select(F.col("up").alias("_of"), F.col("n").alias("child"))
    tour = with_next.join(first, F.col("n") == F.col("_of"), "left")
    into, back = (2 * F.col("n")).alias("arc"), (2 * F.col("n") + 1).alias("arc")
    arcs = tour.select(into, F.coalesce(2 * F.col("child"), 2 * F.col("n") + 1).alias("next"), F.col("score").alias("weight")).unionByName(
        tour.select(back, F.coalesce(2 * F.col("following"), 2 * F.col("up") + 1).alias("next"), F.lit(0).cast("long").alias("weight"))
    )
    ranked = _ranked(arcs).withColumn("n", F.shiftright("arc", 1))
    down = F.col("arc") % 2 == 0
    both = ranked.groupBy("n").agg(
        F.max(F.when(down, F.col("left"))).alias("from_in"),
        F.max(F.when(~down, F.col("left"))).alias("from_out"),
        F.max(F.when(down, F.col("sum"))).alias("sum_in"),
        F.max(F.when(~down, F.col("sum"))).alias("sum_out"),
    )
    lengths = named.groupBy("post").agg((2 * F.count("*")).alias("steps"))
    lengths = lengths.select(F.col("post").alias("_of_post"), "steps")
    both = both.select(dealt_anew(both, "n").alias("_n"), "from_in", "from_out", "sum_in", "sum_out")
    measured = named.join(both, F.col("n") == F.col("_n")).join(lengths, F.col("post") == F.col("_of_post")).select(
        F.col("post").alias(post),
        F.col("node").alias(key),
        (F.col("steps") - F.col("from_in")).alias("enter"),
        (F.col("steps") - F.col("from_out")).alias("leave"),
        F.expr("(from_in - from_out + 1) div 2").alias("subtree_size"),
        (F.col("sum_in") - F.col("sum_out")).alias("subtree_score"),
    )
    return walked.join(measured, [post, key])


def is_above(upper: str = "a", lower: str = "b", post: str = "post_id"):
    """The condition under which the comment of alias ``upper`` is an ancestor of that of ``lower``."""
    at = lambda side, name: F.col(f"{side}.{name}")
    return (at(upper, post) == at(lower, post)) & (at(upper, "enter") < at(lower, "enter")) & (at(upper, "leave") > at(lower, "leave"))
