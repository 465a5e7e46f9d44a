"""Lemmas by morphology: suffixes are detached and what is left is looked up in a table of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .sizing import dealt_anew

# Endings of inflected forms and what stands in their place in the lemma.
ENDINGS = {
    "noun": (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")),
    "verb": (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")),
    "adjective": (("er", ""), ("est", ""), ("er", "e"), ("est", "e")),
}


def _candidates(word: Column, part: str) -> Column:
    """The word itself and what its endings leave, numbered in order; ``part`` is a kind of word."""
    made = [F.struct(F.lit(0).alias("rule"), word.alias("candidate"))]
    for number, (ending, instead) in enumerate(ENDINGS[part], 1):
        left = F.concat(F.left(word, F.char_length(word) - len(ending)), F.lit(instead))
        long_enough = F.char_length(word) > len(ending)
        made.append(F.when(F.endswith(word, F.lit(ending)) & long_enough, F.struct(F.lit(number).alias("rule"), left.alias("candidate"))))
    return F.array_compact(F.array(*made))


def lemma_table(words: DataFrame, known: DataFrame, part: str = "noun", exceptions: DataFrame | None = None, word: str = "word") -> DataFrame:
    """``(word, lemma)`` of the different words of a column.

    ``known`` holds the words of the language in a column ``word``.  The lemma is
    the shortest known one among the word itself and the forms that detaching
    the endings of ``part`` ("noun", "verb" or "adjective") leaves, of equally
    short ones that of the earlier rule.  ``exceptions`` (word, lemma) holds the
    irregular forms and goes before the rules, the least lemma counting where
    a word has several.  A word that is neither known, nor has a known form, nor
    is an exception is its own lemma.  Null words are left out.

    Candidates are looked up by a join over the different words: at most ten
    short rows for each, whatever the number of texts.
    """
    if part not in ENDINGS:
        raise ValueError(f"part cannot be {part!r}; choose from {', '.join(ENDINGS)}")
    distinct = words.where(F.col(word).isNotNull()).select(F.col(word).alias("word")).distinct()
    tried = distinct.select("word", F.explode(_candidates(F.col("word"), part)).alias("c")).select("word", "c.*")
    table = known.where("word IS NOT NULL").select(F.col("word").alias("_known")).distinct()
    table = table.select(dealt_anew(table, "_known").alias("_known"))
    found = tried.join(table, F.col("candidate") == F.col("_known"), "left_semi")
    best = F.min(F.struct(F.char_length("candidate").alias("size"), "rule", F.col("candidate").alias("lemma"))).alias("b")
    chosen = found.select(F.col("word"), "rule", "candidate").groupBy("word").agg(best).select("word", F.col("b.lemma").alias("lemma"))
    sides = [distinct.select("word", F.lit(2).alias("rank"), F.col("word").alias("lemma")), chosen.select("word", F.lit(1).alias("rank"), "lemma")]
    if exceptions is not None:
        odd = exceptions.where("word IS NOT NULL AND lemma IS NOT NULL").join(distinct, "word", "left_semi")
        sides.append(odd.select("word", F.lit(0).alias("rank"), "lemma"))
    together = sides[0]
    for side in sides[1:]:
        together = together.unionByName(side)
    # The word itself, its best form and its exceptions side by side: the first of them counts.
    return together.groupBy("word").agg(F.min(F.struct("rank", "lemma")).alias("b")).select("word", F.col("b.lemma").alias("lemma"))
