"""Row numbers within groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

_AT, _PIECE, _BEFORE, _TIE = "_number_at", "_number_piece", "_number_before", "_number_tie"


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """``df`` with the row's number in its group, from 1, in the given order.

    The rows are range-partitioned by group and order, so a hot group is cut
    into pieces that lie in several tasks.  Each piece knows where it begins in
    its partition and how many rows of the group lie in earlier pieces; a join
    on (group, piece) turns that into numbers, and no task holds more of a group
    than one piece.  Equal rows get different numbers in an arbitrary but fixed
    order: the dealt rows are checkpointed, so a lost executor cannot renumber
    them.
    """
    keys = [F.col(c).asc_nulls_first() for c in group]
    # The place in the input comes last, so that a crowd of equal rows is cut as well.
    order = [*order, F.col(_TIE)]
    dealt = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .drop(_TIE)
        .withColumn(_AT, F.monotonically_increasing_id())
    )
    dealt = cut_lineage(dealt).withColumn(_PIECE, F.shiftright(_AT, 33))
    earlier = Window.partitionBy(*group).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    pieces = dealt.groupBy(*group, _PIECE).agg(F.min(_AT).alias("_first"), F.count("*").alias("_n"))
    starts = pieces.select(
        *[F.col(c).alias(f"_number_{i}") for i, c in enumerate(group)],
        F.col(_PIECE).alias("_number_of_piece"),
        before.alias(_BEFORE),
    )
    same = F.col(_PIECE) == F.col("_number_of_piece")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_number_{i}"))
    return dealt.join(starts, same).select(
        *[c for c in df.columns if c != name], (F.col(_AT) + F.col(_BEFORE)).cast("long").alias(name)
    )
