"""Mixing sources to target weights by weighted fair queueing, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.position import number_rows
from ..operators.sizing import dealt_anew
from ..session import cut_lineage
from .batches import fresh

#: A word is a run of other characters than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _level(sources: DataFrame, total: int, most: int, rounds: int = 10_000) -> tuple[int, int]:
    """``(rest, weights)`` such that ``rest * weight / weights`` fills every source below its ceiling, for a sum of ``total``.

    All sources share by weight; those above ``most`` times their size stop
    there, and the rest is shared anew among the others until none is above.
    Each round is one aggregate whose sums come to the driver.
    """
    ceiling = most * F.col("source_size")
    rest, weights, stopped = total, None, F.lit(False)
    for _ in range(rounds):
        full = F.coalesce(F.sum(F.when(stopped, ceiling)), F.lit(0))
        open_ = F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0))
        capped, left = sources.agg(full.cast("long"), open_.cast("long")).first()
        if left == weights or not left:
            break
        rest, weights = total - capped, left
        # In whole numbers: rest * weight / weights > ceiling.
        exact = "decimal(38,0)"
        stopped = F.lit(rest).cast(exact) * F.col("weight") > ceiling.cast(exact) * F.lit(weights)
    else:
        raise RuntimeError(f"targets did not settle in {rounds} rounds")
    return rest, weights or 1


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights: int = 3, most: int = 3) -> DataFrame:
    """``(source, source_size, weight, target)`` of every source of ``sizes``.

    Sources in code-point order, null last, weigh 1 to ``weights`` in turn and
    share the sum of all sizes by weight.  No target is above ``most`` times its
    source's size; what such a source cannot take is shared among the others.
    """
    sums = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    # All in one group: numbered by range pieces, not in one task.
    ranked = number_rows(sums.withColumn("_all", F.lit(0)), ["_all"], [F.col("source").asc_nulls_last()], "_rank")
    weighed = cut_lineage(
        ranked.select("source", "source_size", ((F.col("_rank") - 1) % weights + 1).cast("long").alias("weight"))
    )
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0).cast("long"))).first()[0]
    rest, shared = _level(weighed, total, most)
    part = (F.lit(rest).cast("long") * F.col("weight")).cast("double") / F.lit(float(shared))
    return weighed.withColumn("target", F.least(part, (most * F.col("source_size")).cast("double")))


def running_sum(df: DataFrame, group: list[str], order: list[Column], size: str, name: str) -> DataFrame:
    """``df`` with the sum of ``size`` over the rows of its group up to and including its own.

    Rows are dealt by ranges of (group, order), so a group that holds a third
    of all rows is cut over many tasks.  Sums of the ranges give where each
    range begins; only within one range a window adds up rows.  The dealt rows
    are checkpointed, so that a lost executor cannot deal them differently.
    """
    at, piece, before, of = (fresh(n, df) for n in ("_at", "_piece", "_before", "_of_piece"))
    same_group = [fresh(f"_group{i}", df) for i in range(len(group))]
    keys = [F.col(c).asc_nulls_first() for c in group]
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(at, F.monotonically_increasing_id())
    dealt = cut_lineage(dealt).withColumn(piece, F.shiftright(at, 33))
    earlier = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*group, piece).agg(F.sum(size).alias("_sum"))
    starts = sums.select(
        *[F.col(c).alias(n) for c, n in zip(group, same_group)],
        F.col(piece).alias(of),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0).cast("long")).alias(before),
    )
    within = Window.partitionBy(*group, piece).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col(piece) == F.col(of)
    for c, n in zip(group, same_group):
        same = same & F.col(c).eqNullSafe(F.col(n))
    summed = dealt.withColumn(name, F.sum(size).over(within)).join(starts, same)
    return summed.withColumn(name, F.col(name) + F.col(before)).drop(at, piece, of, before, *same_group)


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: int = 3,
    most: int = 3,
    seed: str = "mix",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target and taken.

    Targets are those of ``source_targets``, their sum the size of all
    documents.  The documents of a source stand in a queue, shuffled by a
    digest of seed, id and text, and the queue is passed up to ``most`` times.
    A document finishes at the virtual time (sizes of the source up to its end
    in this pass, and all of the passes before) / target.  All finish times are sorted
    by ranges, and what comes before the running sum exceeds the total budget
    is taken, whole documents only.  ``taken`` is the size times the passes in
    which the document is taken, so no more than ``most`` times its size.  At
    the cut every source stands at the same virtual time but for one document.

    ``size`` is the number of words unless given; documents of size zero (null
    and empty texts among them) take part with zero.  The null source is a
    source.  Rows that repeat id, source and text are rows of their own; which
    of them comes first makes no difference to the result.  Other columns are
    ignored, an empty table gives an empty result.  Nothing depends on the
    order or the partitions of the input.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    light = cut_lineage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            (words(text) if size is None else size.cast("long")).alias("size"),
            key.alias("key"),
        )
    )
    targets = source_targets(light, weights=weights, most=most)
    few = targets.select(dealt_anew(targets, "source").alias("_source"), "source_size", "weight", "target")
    queued = running_sum(light, ["source"], [F.col("key"), F.col("doc_id")], "size", "end")
    # Copies of a source: the passes that its target needs, one more for the document at the end.
    passes = F.least(F.lit(most).cast("double"), F.floor(F.col("target") / F.greatest("source_size", F.lit(1))) + 1).cast("int")
    sourced = cut_lineage(
        queued.join(few, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("row", F.monotonically_increasing_id())
    )
    copies = sourced.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), passes))).select(
        "row",
        "size",
        "source",
        "pass",
        "key",
        (((F.col("pass") - 1) * F.col("source_size") + F.col("end")).cast("double") / F.col("target")).alias("finish"),
    )
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("pass"), F.col("key"), F.col("row")]
    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0).cast("long"))).first()[0]
    line = running_sum(copies.withColumn("all", F.lit(0)), ["all"], order, "size", "line")
    taken = line.where(F.col("line") <= budget).groupBy("row").agg(F.sum("size").alias("taken"))
    taken = taken.select(dealt_anew(taken, "row").alias("_row"), "taken")
    return sourced.join(taken, F.col("row") == F.col("_row"), "left").select(
        F.col("doc_id").alias(doc_id), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )

