"""Column transforms."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import TextOptions, clean
from .vocab import lemmatize

Derivation = Column | str | Callable[[DataFrame], Column]


def add_fields(df: DataFrame, derivations: Mapping[str, Derivation]) -> DataFrame:
    """Add or replace columns, each computed from the original row.

    All derivations go into one projection, so none sees another's result.
    A derivation is a ``Column``, SQL text, or a function of the frame.
    """

    def column(rule: Derivation) -> Column:
        if isinstance(rule, Column):
            return rule
        return F.expr(rule) if isinstance(rule, str) else rule(df)

    return df.withColumns({name: column(rule) for name, rule in derivations.items()})


def clean_fields(
    df: DataFrame,
    fields: Iterable[str],
    options: TextOptions | None = None,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """Clean the named text columns in place; null stays null, absent names are skipped."""
    options = options or TextOptions()
    present = [name for name in fields if name in df.columns]
    if options.lemmatization and lemmas is None:
        raise ValueError("lemmatization needs a table of (word, lemma)")
    df = df.withColumns(
        {n: F.when(F.col(n).isNotNull(), clean(F.col(n), options)) for n in present}
    )
    if options.lemmatization:
        for name in present:
            df = lemmatize(df, name, lemmas)
    return df


def optional(df: DataFrame, name: str, kind: T.DataType | str) -> Column:
    """The column if the frame has it, otherwise a typed null."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def records(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the stored columns, in stored order."""
    return df.select(*schema.names)
