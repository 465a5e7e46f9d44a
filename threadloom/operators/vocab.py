"""Lemmatisation against a table of (word, lemma)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.arrow import map_words
from ..session import bound_batches
from .sizing import dealt_anew, fits_broadcast

MAP_ROWS = 500_000


def lemmatize(df: DataFrame, column: str, lemmas: DataFrame, strategy: str = "auto") -> DataFrame:
    """Replace each blank-separated word of ``column`` by its lemma.

    Words without a lemma are kept, null text stays null; of several lemmas for
    a word the least counts.  Rows need no key and may repeat.  Two plans give
    the same texts:

    ``map``
        the lemma table is sent to the executors and looked up in Arrow
        batches; nothing is shuffled.  The table passes through the driver like
        any broadcast table, so one beyond the session's broadcast threshold or
        of more than ``MAP_ROWS`` words is joined all the same.
    ``join``
        for a table of any size.

    ``auto`` is ``map`` where the table allows it.
    """
    if strategy not in ("auto", "map", "join"):
        raise ValueError(f"unknown strategy: {strategy}")
    useful = lemmas.where("word IS NOT NULL AND lemma IS NOT NULL AND word <> lemma")
    table = useful.groupBy("word").agg(F.min("lemma").alias("lemma"))
    if strategy != "join" and fits_broadcast(lemmas):
        pairs = table.limit(MAP_ROWS + 1).collect()
        if len(pairs) <= MAP_ROWS:
            return _by_map(df, column, dict(pairs))
    return _by_join(df, column, table)


def _by_map(df: DataFrame, column: str, pairs: dict[str, str]) -> DataFrame:
    lemma_of = bound_batches(df.sparkSession).sparkContext.broadcast(pairs)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def look_up(words: pa.Array) -> pa.Array:
        known = lemma_of.value
        return map_words(words, lambda word: known.get(word, word))

    return df.withColumn(column, F.array_join(look_up(F.split(F.col(column), " ")), " "))


def _by_join(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Look up the distinct words of each distinct text by a join.

    A text is named by its SHA-256, so equal texts are looked up once and the
    rows need no key.  Only (digest, word) pairs take part, never the other
    columns, and only words that have a lemma come back.  The rows are the left
    side of the last join: adaptive execution splits a text that many rows share.
    """
    digest = F.unhex(F.sha2(F.col(column).cast("binary"), 256))
    words = df.where(F.col(column).isNotNull()).select(
        digest.alias("_digest"), F.explode(F.array_distinct(F.split(F.col(column), " "))).alias("word")
    )
    # Joined first: of the words of all texts, only those that have a lemma are sorted out by text.
    found = (
        words.join(table.select(dealt_anew(table, "word").alias("word"), "lemma"), "word")
        .distinct()
        .groupBy("_digest")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_lemmas"))
    )
    replaced = F.array_join(
        F.transform(
            F.split(F.col(column), " "),
            lambda word: F.coalesce(F.try_element_at(F.col("_lemmas"), word), word),
        ),
        " ",
    )
    text = F.when(F.col("_lemmas").isNull(), F.col(column)).otherwise(replaced)
    found = found.select(dealt_anew(found, "_digest").alias("_digest"), "_lemmas")
    return df.join(found, digest == F.col("_digest"), "left").withColumn(column, text).select(*df.columns)
