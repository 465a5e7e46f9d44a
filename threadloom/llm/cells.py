"""Members that share a cell, compared block against block.

Cells are the buckets of a locality-sensitive hash.  A cell may hold a third of
all members.  It is therefore cut into chunks of about ``block`` members, and
every pair of chunks is one unit of work: a unit holds at most about two chunks,
units of one cell run in different tasks, and every two members of a cell meet
in at least one unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import dealt_anew

def units(members: DataFrame, cell: str, node: str, block: int = 2048) -> DataFrame:
    """``members`` (one row per cell and node) with the units that each row belongs to.

    Adds _low and _high, the unit's chunks, and _chunk, the row's own.  Cells of
    one member are dropped before the join, which is the only place where whole
    cells count, and there as sums.  Every row of a cell of ``c`` chunks goes to
    the ``c`` units of its chunk.
    """
    sums = members.groupBy(F.col(cell).alias("_of")).agg(F.count("*").alias("_size")).where("_size > 1")
    chunks = sums.select(dealt_anew(sums, "_of").alias("_of"), F.ceil(F.col("_size") / block).cast("int").alias("_chunks"))
    placed = members.join(chunks, F.col(cell) == F.col("_of")).withColumn(
        "_chunk", F.pmod(F.xxhash64(node, F.lit(11)), F.col("_chunks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    return placed.withColumn("_other", other).select(
        *members.columns,
        F.least("_chunk", "_other").alias("_low"),
        F.greatest("_chunk", "_other").alias("_high"),
        "_chunk",
    )


def deal(rows: DataFrame, cell: str) -> DataFrame:
    """Rows of ``units`` with each unit in one task, in one piece."""
    key = [cell, "_low", "_high"]
    return rows.repartition(*key).sortWithinPartitions(*key)


def grouped(batches: Iterable[pa.RecordBatch], cell: str, most_rows: int = 65_536) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole units out of sorted rows, with the places where the units begin.

    A run has about ``most_rows`` rows, or one unit if that has more.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def cut(table: pa.Table) -> np.ndarray:
        keys = [table.column(c).to_numpy() for c in (cell, "_low", "_high")]
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= most_rows:
            table = pa.Table.from_batches(held)
            starts = cut(table)
            if len(starts) > 1:
                yield table.slice(0, int(starts[-1])), starts[:-1]
                table = table.slice(int(starts[-1]))
            held, rows = table.to_batches(), 0 if len(starts) > 1 else -table.num_rows
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield table, cut(table)


def forest(count: int, linked: Callable[[int], np.ndarray]) -> np.ndarray:
    """For each of ``count`` members the smallest member it is connected to.

    ``linked(i)`` returns the members linked to ``i``; labels are joined row by
    row, so no list of pairs is kept.
    """
    label = np.arange(count)
    for i in range(count):
        near = linked(i)
        if len(near):
            labels = np.unique(np.append(label[near], label[i]))
            if len(labels) > 1:
                label[np.isin(label, labels[1:])] = labels[0]
    return label
