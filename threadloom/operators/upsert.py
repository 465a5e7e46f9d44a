"""Keyed merges of a batch of updates into a base table.

Each function first reduces the batch to the last row per key in ``order_by``;
with two rows for one key a join would multiply the base rows.  ``order_by=None``
says that the keys of the batch are unique and saves that step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .dedup import keep_last
from .sizing import fits_broadcast

_NEW = "_update"
Order = Sequence[str | Column] | None


def latest_rows(
    updates: DataFrame, key: str, order_by: Order = (), unique_order: bool = False
) -> DataFrame:
    """The rows of a batch that an upsert applies: one per key, none without a key."""
    if order_by is None:
        return updates.where(F.col(key).isNotNull())
    return keep_last(updates, key, order_by, unique_order)


def merge_columns(
    base: DataFrame,
    updates: DataFrame,
    key: str = "id",
    order_by: Order = (),
    strategy: str = "auto",
    unique_order: bool = False,
) -> DataFrame:
    """Overwrite the columns the batch has, keep the others, insert new keys.

    A null in the batch overwrites; only a column the batch lacks is kept.  The
    keys of ``base`` must be unique.  Columns of the base keep their types,
    whatever the types of the batch.  Two plans give the same rows:

    ``full_outer``
        one full outer join, which shuffles the base once;
    ``lookup``
        a left join for the updates plus anti-joined inserts.  Both look-ups
        have the batch as their small side, so the base is not shuffled.  The
        reduced batch is checkpointed first, so that it is computed once.

    ``auto`` takes ``lookup`` when the batch fits the broadcast threshold.
    """
    latest = latest_rows(updates, key, order_by, unique_order)
    if strategy == "auto":
        strategy = "lookup" if fits_broadcast(latest) else "full_outer"
    if strategy not in ("full_outer", "lookup"):
        raise ValueError(f"unknown strategy: {strategy}")
    columns = base.columns + [c for c in latest.columns if c not in base.columns]
    kinds = {f.name: f.dataType for f in [*latest.schema, *base.schema]}
    latest = latest.withColumns({c: F.col(c).cast(kinds[c]) for c in latest.columns})
    if strategy == "lookup":
        latest = cut_lineage(latest)
    packed = latest.select(key, F.struct(*latest.columns).alias(_NEW))

    def pick(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name not in latest.columns:
            return F.col(name)
        kept = F.col(name) if name in base.columns else F.lit(None)
        return F.when(F.col(_NEW).isNotNull(), F.col(f"{_NEW}.{name}")).otherwise(kept).alias(name)

    if strategy == "full_outer":
        return base.join(packed, key, "full_outer").select(*[pick(c) for c in columns])
    updated = base.join(packed, key, "left").select(*[pick(c) for c in columns])
    known = base.select(key).join(latest.select(key), key, "left_semi")
    inserted = latest.join(known, key, "left_anti")
    return updated.unionByName(inserted, allowMissingColumns=True)


def replace_rows(
    base: DataFrame,
    updates: DataFrame,
    key: str = "id",
    order_by: Order = (),
    unique_order: bool = False,
) -> DataFrame:
    """Replace whole rows by key and add new ones; columns the batch lacks become null."""
    latest = latest_rows(updates, key, order_by, unique_order)
    kept = base.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True).select(
        *base.columns, *[c for c in latest.columns if c not in base.columns]
    )


def append_keep_last(
    base: DataFrame,
    updates: DataFrame,
    key: str = "id",
    order_by: Order = (),
    base_is_unique: bool = False,
    unique_order: bool = False,
) -> DataFrame:
    """Concatenate and keep the last row per key; batch rows come after base rows.

    With ``base_is_unique`` nothing inside the base can be a duplicate, and the
    result equals :func:`replace_rows`, which does not shuffle the base for a
    small batch.
    """
    if base_is_unique:
        return replace_rows(base.where(F.col(key).isNotNull()), updates, key, order_by, unique_order)
    marked = base.withColumn("_batch", F.lit(0)).unionByName(
        updates.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(marked, key, ["_batch", *(order_by or ())], unique_order).drop("_batch")
