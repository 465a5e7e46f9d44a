"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def concat(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def corpus(*parts: tuple[str, DataFrame, str, str]) -> DataFrame:
    """Texts of several tables as ``(kind, id, text)``; null text becomes empty.

    Each part is ``(kind, frame, id column, text column)``.  A union has no row
    order, so kind and id identify where a text came from.
    """
    shaped = [
        df.select(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("id"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        for kind, df, key, text in parts
    ]
    return reduce(DataFrame.unionByName, shaped)
