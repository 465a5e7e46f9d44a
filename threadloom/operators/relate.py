"""Relations between posts and comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .position import number_rows


_KEY = "_join_key"


def _prefixed(
    df: DataFrame, key: str, taken: Sequence[str], prefix: str, drop_key: bool = False
) -> DataFrame:
    """Rename colliding columns and copy (or move) the join key to a name of its own."""
    kept = [c for c in df.columns if not (drop_key and c == key)]
    names = {c: prefix + c if c in taken else c for c in kept}
    clash = [n for c, n in names.items() if n != c and (n in taken or n in kept)]
    if clash:
        raise ValueError(f"choose another prefix, these columns exist twice: {', '.join(clash)}")
    return df.select(F.col(key).alias(_KEY), *[F.col(c).alias(n) for c, n in names.items()])


def with_children(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str = "id",
    child_key: str = "post_id",
    how: str = "inner",
    prefix: str = "comment_",
) -> DataFrame:
    """One row per parent and child; child columns that collide get a prefix.

    ``how="left"`` also keeps parents without children.  Parent keys are
    unique, so a parent with very many children skews the children's side.
    Adaptive execution splits that side of an inner join but not of a left one,
    so the left form is the inner join plus the parents without children.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    renamed = _prefixed(children, child_key, parents.columns, prefix)
    same = parents[parent_key] == renamed[_KEY]
    inner = parents.join(renamed, same).drop(_KEY)
    if how == "inner":
        return inner
    alone = parents.join(renamed.select(_KEY), same, "left_anti")
    return inner.unionByName(alone, allowMissingColumns=True).select(*inner.columns)


def with_parent(
    children: DataFrame,
    parents: DataFrame,
    child_key: str = "post_id",
    parent_key: str = "id",
    prefix: str = "post_",
) -> DataFrame:
    """Each child with the columns of its parent, null where there is none.

    The parent's key is left out: it repeats ``child_key``.
    """
    renamed = _prefixed(parents, parent_key, children.columns, prefix, drop_key=True)
    return children.join(renamed, children[child_key] == renamed[_KEY], "left").drop(_KEY)


def orphans(
    children: DataFrame,
    parents: DataFrame,
    child_key: str = "post_id",
    parent_key: str = "id",
) -> DataFrame:
    """Children whose parent is not in the parent table."""
    keys = parents.select(F.col(parent_key).alias(_KEY))
    return children.join(keys, children[child_key] == keys[_KEY], "left_anti")


def known(df: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key exists in ``table``."""
    return df.join(table.select(key), key, "left_semi")


def unknown(df: DataFrame, table: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key does not exist in ``table``."""
    return df.join(table.select(key), key, "left_anti")


def child_counts(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str = "id",
    child_key: str = "post_id",
    name: str = "comment_count",
) -> DataFrame:
    """Parents with their number of children, zero included."""
    counts = children.groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias(name))
    return parents.join(counts, parent_key, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0).cast("long"))
    )


def collections(
    parents: DataFrame,
    children: DataFrame,
    fields: Sequence[str],
    parent_key: str = "id",
    child_key: str = "post_id",
    name: str = "comments",
    chunk_size: int = 10_000,
) -> DataFrame:
    """Parents with their children as sorted arrays.

    The array holds ``fields`` as structs in field order, so the first field is
    the sort key.  A parent has one row per ``chunk_size`` children, numbered in
    ``chunk`` from 0: every child of chunk k comes before every child of chunk
    k + 1, and no array holds more than ``chunk_size``, whatever the fields.
    Parents without children have one row with an empty array.

    The children are numbered by range pieces and grouped by (parent, chunk),
    so one hot parent is spread over tasks; the parents join these groups by an
    inner join, which adaptive execution can split, and the parents without
    children are added.
    """
    item = F.struct(*fields)
    items = children.where(F.col(child_key).isNotNull()).select(F.col(child_key).alias(_KEY), item.alias("_item"))
    numbered = number_rows(items, [_KEY], [F.col("_item")], "_position")
    chunked = numbered.withColumn("chunk", F.expr(f"(_position - 1) div {int(chunk_size)}"))
    arrays = chunked.groupBy(_KEY, "chunk").agg(F.sort_array(F.collect_list("_item")).alias(name))
    same = F.col(parent_key) == F.col(_KEY)
    some = parents.join(arrays, same).select(*parents.columns, "chunk", name)
    alone = parents.join(items.select(_KEY), same, "left_anti")
    empty = F.array().cast(arrays.schema[name].dataType)
    return some.unionByName(
        alone.select(*parents.columns, F.lit(0).cast("long").alias("chunk"), empty.alias(name))
    )
