"""Keep-last deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "_keep_last_rank"


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return False
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return True


def keep_last(
    df: DataFrame,
    key: str | Sequence[str] = "id",
    order_by: Sequence[str | Column] = (),
    unique_order: bool = False,
) -> DataFrame:
    """One row per key: the last one in ``order_by``; rows without a key are dropped.

    A distributed table has no row order of its own, so "last" is the greatest
    value of the order columns.  Ties are settled by a hash of the row, which
    makes the survivor the same on every re-computation; ``unique_order=True``
    says that the order columns have no ties and saves the hash.

    Spark limits each group to its best row before the shuffle
    (``WindowGroupLimit``), so a key that holds a third of all rows sends one
    row per input task.
    """
    if unique_order and not order_by:
        raise ValueError("unique_order needs order columns")
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c.desc_nulls_last() for c in order_by]
    if not unique_order:
        plain = [F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)]
        order.append(F.xxhash64(*plain).desc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        .withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )
