"""Row filters.  All are plain predicates, so Catalyst can push them to the scan."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import contains_any, iso_to_timestamp, time_literal

Moment = dt.datetime | dt.date | str


def by_date(
    df: DataFrame,
    column: str = "created_utc",
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Keep rows with ``start <= column <= end``.

    Text columns are read as ISO-8601 and rows that are no date are dropped.
    Without bounds the input is returned as it is.
    """
    if start is None and end is None:
        return df
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        value, kind = iso_to_timestamp(value), T.TimestampType()
    # Comparisons reject nulls, so no separate test is needed.
    if start is not None:
        df = df.where(value >= time_literal(start, kind))
    if end is not None:
        df = df.where(value <= time_literal(end, kind))
    return df


def by_score(
    df: DataFrame,
    column: str = "score",
    minimum: float | None = None,
    maximum: float | None = None,
) -> DataFrame:
    """Keep rows with ``minimum <= column <= maximum``; zero is a real bound.

    Rows without a score are dropped.  NaN is dropped too: Spark orders it
    above every number, which would let it pass a minimum.
    """
    if minimum is None and maximum is None:
        return df
    value = F.col(column)
    fractional = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    if minimum is not None:
        df = df.where(value >= minimum)
    if maximum is not None:
        df = df.where(value <= maximum)
    return df.where(~F.isnan(value)) if fractional else df


def by_expr(
    df: DataFrame,
    predicate: Column | str | Callable[[pd.DataFrame], pd.Series],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keep rows for which a user predicate holds.

    A ``Column`` or SQL text stays inside Spark.  A function receives Arrow
    batches as a pandas frame and returns one boolean per row; use it only for
    conditions that Spark functions cannot express.  ``columns`` limits what is
    sent to it.
    """
    if not callable(predicate) or isinstance(predicate, Column):
        return df.where(predicate)

    def decide(rows: pd.DataFrame) -> pd.Series:
        return predicate(rows).astype("boolean")

    keep = F.pandas_udf(decide, T.BooleanType())
    return df.where(keep(F.struct(*[F.col(f"`{c}`") for c in columns or df.columns])))


def by_keywords(df: DataFrame, keywords: list[str], column: str = "title") -> DataFrame:
    """Keep rows whose lower-cased text holds any keyword as a substring."""
    return df.where(contains_any(F.col(column), keywords))


def _equals(column: Column, kind: T.DataType, value: Any) -> Column:
    """Equality as between the values themselves: another type is another value.

    Numbers and booleans compare with each other, texts with texts, times with
    times and with ISO text.  The value becomes a literal of the column's kind,
    so the filter reaches the scan and no row is cast.
    """
    never = F.lit(False)
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return column == F.lit(value) if isinstance(value, str) else never
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        try:
            return column == time_literal(value, kind) if isinstance(value, (str, dt.date)) else never
        except ValueError:
            return never
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        if not isinstance(value, (bool, int, float, decimal.Decimal)) or value != value:
            return never
        if isinstance(kind, T.BooleanType):
            return column == F.lit(bool(value)) if value in (0, 1) else never
        if isinstance(value, (bool, int)):
            value = int(value)
            return column == F.lit(value) if -(1 << 63) <= value < 1 << 63 else never
        return column == F.lit(value)
    return column == F.lit(value)


def by_equality(
    df: DataFrame, filters: Mapping[str, Any] | None, on_unknown: str = "raise"
) -> DataFrame:
    """Keep rows where every named column equals its value.

    ``None`` asks for null.  A value of another type than the column's matches
    no row.  A name that is no column raises by default and is skipped with
    ``on_unknown="ignore"``.
    """
    if on_unknown not in ("raise", "ignore"):
        raise ValueError(f"on_unknown must be 'raise' or 'ignore', not {on_unknown!r}")
    for name, value in (filters or {}).items():
        if name not in df.columns:
            if on_unknown == "raise":
                raise ValueError(f"unknown filter column: {name}")
            continue
        column = F.col(name)
        df = df.where(column.isNull() if value is None else _equals(column, df.schema[name].dataType, value))
    return df


def having(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows that have a value in every named column."""
    return df.dropna(how="any", subset=list(columns))
