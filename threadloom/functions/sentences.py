"""Sentence borders learnt from the corpus, and punctuation as tokens.

Whether a full stop ends a sentence is told by statistics of the texts themselves
(Kiss and Strunk, 2006), without a list of abbreviations: a word that nearly always
stands with a full stop, and is short, is an abbreviation by a log-likelihood ratio;
behind an abbreviation a sentence begins with a word in upper case that is
written in lower case elsewhere and never in upper case inside a sentence.  The
statistics are frozen in a ``SentenceModel`` and applied text by text in built-in functions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# White space as in ``text``; quotes and brackets that close and open.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
CLOSERS = r"""["'”’»)\]}]+$"""
_CLOSING = "\"'”’»)]}"  # of CLOSERS
OPENERS = r"""^["'“‘«(\[{]+"""

# The Treebank convention for punctuation, in its order.  The text has single blanks,
# one at either end; the last rule but seven concerns the full stop that ends the sentence.
TREEBANK = [
    (' "', " `` "),
    (r'([(\[{<])"', "$1 `` "),
    (r"\.\.\.", " ... "),
    (r"([;@#$%&])", " $1 "),
    (r"([:,])([^0-9])", " $1 $2"),
    (r"""([^.])(\.)([\])}>"']*) $""", "$1 $2$3 "),
    (r"([?!])", " $1 "),
    (r"([\]\[(){}<>])", " $1 "),
    ("--", " -- "),
    ('"', " '' "),
    (r"([^'])' ", "$1 ' "),
    (r"([^' ])('[sSmMdD]) ", "$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
]


def words(text: Column) -> Column:
    """The runs of a text without white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def separate_punctuation(sentence: Column) -> Column:
    """A sentence with blanks around its punctuation."""
    out = F.concat(F.lit(" "), F.array_join(words(sentence), " "), F.lit(" "))
    for pattern, change in TREEBANK:
        out = F.regexp_replace(out, pattern, change)
    return out


def _bare(word: Column) -> Column:
    """Without closing quotes and brackets."""
    return F.regexp_replace(word, CLOSERS, "")


def _core(word: Column) -> Column:
    """Without quotes, brackets and one full stop at the end; in the case it has."""
    return F.regexp_replace(F.regexp_replace(_bare(word), r"\.$", ""), OPENERS, "")


def _marked(word: Column) -> Column:
    """Whether a word has a mark that may end a sentence: told before any pattern is tried."""
    return F.contains(word, F.lit(".")) | F.contains(word, F.lit("?")) | F.contains(word, F.lit("!"))


def _ends(word: Column) -> Column:
    return _marked(word) & _bare(word).rlike(r"[.?!]$")


def _upper(word: Column) -> Column:
    first = F.substring(F.regexp_replace(word, OPENERS, ""), 1, 1)
    return first != F.lower(first)


def _lower(word: Column) -> Column:
    first = F.substring(F.regexp_replace(word, OPENERS, ""), 1, 1)
    return first != F.upper(first)


@dataclass(frozen=True)
class SentenceModel:
    """Abbreviations (lower case, without the last full stop) and the words that begin a sentence behind one."""

    abbreviations: tuple[str, ...] = ()
    starters: tuple[str, ...] = ()


def _listed(batch: pa.RecordBatch) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts of a batch behind one another, and which of them begin a text.

    Python's blanks are those of ``SPACE``.
    """
    split = [t.split() for t in batch.column(0).to_pylist() if t is not None]
    first = np.zeros(sum(map(len, split)) + 1, bool)
    first[np.cumsum([0, *map(len, split)])] = True
    return pa.array([w for found in split for w in found], pa.string()).dictionary_encode(), first[:-1]


def _summed(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _raw_counts(df: DataFrame, text: str, held: int = 200_000) -> DataFrame:
    """(word, later, after_end, n): words as they stand, whether another precedes them in the text, and whether that one ends a sentence."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        kinds, names = [pa.string(), pa.bool_(), pa.bool_(), pa.int64()], ["word", "later", "after_end", "n"]

        def made() -> pa.RecordBatch:
            return _summed([(w, k > 0, k > 1 if k else None, n) for (w, k), n in seen.items()], kinds, names)

        for batch in batches:
            listed, first = _listed(batch)
            different, code = listed.dictionary.to_pylist(), listed.indices.to_numpy().astype(np.int64)
            ends = np.array([w.rstrip(_CLOSING).endswith((".", "?", "!")) for w in different], bool)
            # 0: first of its text, 1: later, 2: later and behind the end of a sentence.
            kind = np.where(first, 0, 1 + np.append(False, ends[code[:-1]])[: len(code)])
            cells, counts = np.unique(code * 3 + kind, return_counts=True)
            for cell, n in zip(cells.tolist(), counts.tolist()):
                seen[different[cell // 3], cell % 3] += n
            if len(seen) > held:
                yield made()
                seen.clear()
        yield made()

    counted = df.select(F.col(text)).mapInArrow(run, "word string, later boolean, after_end boolean, n long")
    return counted.groupBy("word", "later", "after_end").agg(F.sum("n").alias("n"))


def _behind_stops(df: DataFrame, text: str) -> DataFrame:
    """(before, word): the different pairs of neighbouring words of which the first has a full stop at its end."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed, first = _listed(batch)
            different, code = listed.dictionary.to_pylist(), listed.indices.to_numpy().astype(np.int64)
            stops = np.array([w.rstrip(_CLOSING).endswith(".") for w in different], bool)
            at = np.flatnonzero(stops[code[:-1]] & ~first[1:]) if len(code) else code
            pairs = np.unique(code[at] * max(len(different), 1) + code[at + 1]) if len(at) else at
            rows = [(different[p // len(different)], different[p % len(different)]) for p in pairs.tolist()]
            yield _summed(rows, [pa.string()] * 2, ["before", "word"])

    return df.select(F.col(text)).mapInArrow(run, "before string, word string")


def word_statistics(df: DataFrame, text: str) -> DataFrame:
    """(type, stopped, plain, lower, upper_inside) over all texts.

    A type is a word in lower case without quotes, brackets and its last full
    stop.  Counted are its occurrences with and without that full stop, those
    that begin with a letter in lower case, and those in upper case behind a
    word that ends no sentence.  Words are counted as they stand first, in Arrow
    batches; only different ones are taken apart.
    """
    raw = _raw_counts(df, text)
    word, bare = F.col("word"), _bare(F.col("word"))
    stopped = bare.rlike(r"(^|[^.])\.$")
    inside = F.col("later") & ~F.col("after_end")
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias
    return (
        raw.withColumns({"type": F.lower(_core(word)), "stop": stopped, "low": _lower(word), "up": _upper(word) & F.coalesce(inside, F.lit(False))})
        .groupBy("type")
        .agg(n(F.col("stop"))("stopped"), n(~F.col("stop"))("plain"), n(F.col("low"))("lower"), n(F.col("up"))("upper_inside"))
    )


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    return k * F.log(p) + (n - k) * F.log(F.lit(1.0) - p)


def abbreviation_score(share: float) -> Column:
    """How much a type of ``word_statistics`` looks like an abbreviation, ``share`` being that of all words with a full stop.

    Twice the log-likelihood of a full stop at 99 % against the share of the
    corpus, less for long types and for each occurrence without a full stop,
    more for full stops inside.
    """
    k, n = F.col("stopped").cast("double"), (F.col("stopped") + F.col("plain")).cast("double")
    gain = 2 * (_log_likelihood(k, n, F.lit(0.99)) - _log_likelihood(k, n, F.lit(share)))
    letters = F.char_length(F.regexp_replace("type", r"\.", ""))
    inner = F.char_length("type") - letters
    return gain * F.exp(-letters.cast("double")) * (inner + 1) * F.pow(letters.cast("double"), -F.col("plain").cast("double"))


def fit_sentences(df: DataFrame, text: str, least: float = 0.3, most: int = 100_000) -> SentenceModel:
    """Learn abbreviations and sentence starters from all texts of a column.

    Two passes: word counts, and the words behind abbreviations.  The model is
    two lists of words on the driver; more than ``most`` of either is an error,
    as texts so unlike prose have no sentences to learn.
    """
    from ..session import bound_batches, cut_lineage

    bound_batches(df.sparkSession)
    counted = cut_lineage(word_statistics(df, text))
    total = counted.agg(F.sum("stopped").alias("stopped"), F.sum(F.col("stopped") + F.col("plain")).alias("all")).first()
    if not total["stopped"]:
        return SentenceModel()
    share = min(max(total["stopped"] / total["all"], 1e-9), 1 - 1e-9)
    likely = (F.col("stopped") > 0) & F.col("type").rlike(r"\p{L}") & (abbreviation_score(share) >= least)
    found = _bounded([r["type"] for r in counted.where(likely).select("type").limit(most + 1).collect()], most)
    follows = _abbreviated(F.col("before"), found) & _upper(F.col("word"))
    behind = _behind_stops(df, text).where(follows).select(F.lower(_core(F.col("word"))).alias("type")).distinct()
    begins = counted.where("lower > 0 AND upper_inside = 0").join(behind, "type", "left_semi")
    starters = _bounded([r["type"] for r in begins.select("type").limit(most + 1).collect()], most)
    return SentenceModel(tuple(found), tuple(starters))


def _bounded(found: list[str], most: int) -> list[str]:
    if len(found) > most:
        raise ValueError(f"more than {most} words to learn; are these texts?")
    return sorted(found)


def _abbreviated(word: Column, abbreviations) -> Column:
    """A word with one full stop at its end that is an abbreviation or an initial."""
    core = _core(word)
    return _bare(word).rlike(r"(^|[^.])\.$") & (F.lower(core).isin(list(abbreviations)) | core.rlike(r"^\p{L}$"))


def _border(word: Column, after: Column, model: SentenceModel) -> Column:
    """Whether a sentence ends with a word."""
    bare = _bare(word)
    ends = (
        F.when(bare.rlike(r"[?!]$"), True)
        .when(bare.rlike(r"\.\.$"), _upper(after))
        .when(~bare.rlike(r"\.$"), False)
        .when(_abbreviated(word, model.abbreviations), _upper(after) & F.lower(_core(after)).isin(list(model.starters)))
        .when(~bare.rlike(r"\p{L}"), ~_lower(after))
        .otherwise(True)
    )
    return F.when(after.isNull(), False).when(_marked(word), ends).otherwise(False)


def sentences(text: Column, model: SentenceModel) -> Column:
    """The sentences of a text, their words joined by single blanks; none for null and empty texts."""
    def cut(listed: Column) -> Column:
        ended = F.transform(listed, lambda w, i: F.concat(w, F.when(_border(w, F.get(listed, i + 1), model), "\n").otherwise(" ")))
        return F.filter(F.transform(F.split(F.array_join(ended, ""), "\n"), lambda s: F.trim(s)), lambda s: s != "")

    # Bound to a name: the words would be cut out anew for every word that looks at the next one.
    return F.get(F.transform(F.array(words(text)), cut), F.lit(0))


def sentence_tokens(text: Column, model: SentenceModel | None = None) -> Column:
    """The words and punctuation marks of a text; without a model the text is one sentence."""
    if model is None:
        return F.filter(F.split(separate_punctuation(text), " "), lambda w: w != "")
    return F.filter(F.flatten(F.transform(sentences(text, model), lambda s: F.split(separate_punctuation(s), " "))), lambda w: w != "")
