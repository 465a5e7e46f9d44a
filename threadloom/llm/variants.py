"""Spelling variants: words one edit apart, by a bit-sliced position index over the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.sizing import dealt_anew
from ..session import cut_lineage
from .batches import fresh, pieces, texts
from .cells import deal, grouped, units
from .simhash import _LOWER

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Different words that a task counts before it hands the counts on.
_HELD = 200_000


def run_counts(text: str, least: int) -> Counter:
    """How often each run of letters of at least ``least`` occurs, A to Z in lower case."""
    low = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    return Counter(m[0] for m in _RUN.finditer(low) if m.end() - m.start() >= least)


def misspelt(run: str, begun: int, every: int) -> str:
    """The run, or, where ``every`` divides its hash, the run without one letter."""
    h = zlib.crc32(run.encode(), begun)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, least_letters: int = 5, least_count: int = 3, slip_every: int | None = 97, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(word, n)``: the words of all whole texts and how often they occur.

    Words are maximal runs of the letters A to Z, a to z and U+00C0 to U+00FF,
    A to Z in lower case, of at least ``least_letters``; those that occur less
    than ``least_count`` times are left out.  With ``slip_every``, a run whose
    CRC-32 of ``<doc_id>:<run>`` is a multiple of it loses one letter before it
    is counted: errors at known places, of which a corpus without any would
    have none.  Every task adds up its own words before they are shuffled, so a
    frequent word costs one row per task.  A null text has no words, a null id
    counts as empty.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return out

        for piece in pieces(batches, text):
            for key, body in zip(piece.column(doc_id).to_pylist(), texts(piece, text)):
                begun = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in run_counts(body, least_letters).items():
                    if slip_every:
                        word = misspelt(word, begun, slip_every)
                    if len(word) >= least_letters:
                        counts[word] += n
                if len(counts) >= _HELD:
                    yield made()
        if counts:
            yield made()

    found = docs.select(doc_id, text).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --- the index


def _points(words: Sequence[str], width: int) -> np.ndarray:
    """One row of letters per word, zeros behind it; all letters are below U+0100."""
    flat = b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words)
    return np.frombuffer(flat, np.uint8).reshape(len(words), width)


def _packed(bits: np.ndarray, blocks: int) -> np.ndarray:
    """Rows of booleans as rows of ``blocks`` 64-bit words, the first boolean in the lowest bit."""
    out = np.zeros((len(bits), blocks * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view("<u8")


class PositionIndex:
    """For every position and letter the set of the words that have it there, as a bitset.

    The sets of one position are built when the recurrences get there and
    forgotten after the next two, so words of any length fit.
    """

    def __init__(self, words: Sequence[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.width = int(self.lengths.max())
        self.points = _points(words, self.width)
        self.blocks = -(-len(words) // 64)
        self.letters = np.unique(self.points)
        self.letters = self.letters[self.letters > 0]
        self.slot = np.full(256, len(self.letters), np.int64)  # the last row of a slice is the empty set
        self.slot[self.letters] = np.arange(len(self.letters))

    def at(self, position: int) -> np.ndarray:
        """The bitsets of all letters at a position; beyond the longest word they are empty."""
        out = np.zeros((len(self.letters) + 1, self.blocks), np.uint64)
        if 0 <= position < self.width:
            out[:-1] = _packed(self.points[None, :, position] == self.letters[:, None], self.blocks)
        return out

    def of_length(self, length: int) -> np.ndarray:
        return _packed((self.lengths == length)[None], self.blocks)[0]

    def near(self, queries: Sequence[str], longest: int, share: int, prefix: bool) -> np.ndarray:
        """For each query (all of one length) the set of the words one edit away.

        Either the query or the word, or both, has ``longest`` letters.  Only
        words count that share the first ``share`` letters of the query
        (``prefix``), or only those that do not.
        """
        size = len(queries[0])
        letters = self.slot[_points(queries, size)]
        every = np.full((len(queries), self.blocks), ~np.uint64(0))
        zero = every.copy()
        replaced, extra, lacking = (np.zeros_like(every) for _ in range(3))
        shared = every
        before, here, after = self.at(-1), self.at(0), self.at(1)
        for i in range(size):
            own = letters[:, i]
            same = here[own]
            if size == longest:  # a letter replaced, or one that the word lacks
                replaced = (replaced & same) | (zero & ~same)
                lacking = (lacking & before[own]) | zero
            else:  # the word has one letter more
                extra = (extra | zero) & after[own]
            zero = zero & same
            if i + 1 == share:
                shared = zero
            before, here, after = here, after, self.at(i + 2)
        if size == longest:
            found = (replaced & self.of_length(size)) | (lacking & self.of_length(size - 1))
        else:
            found = (extra | zero) & self.of_length(longest)
        return found & (shared if prefix else ~shared)


def _summed(words: list[str], n: np.ndarray, queries: list[str], longest: int, prefix: bool) -> Iterator[tuple]:
    """(query, near words, the largest n among them, its word) of the queries that have any near word."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))  # the first bit is the best word
    ranked = [words[i] for i in order]
    index = PositionIndex(ranked)
    for size in (longest, longest - 1):
        same = [q for q in queries if len(q) == size]
        for part in range(0, len(same), 256):
            some = same[part : part + 256]
            hits = index.near(some, longest, longest // 2, prefix)
            count = np.bitwise_count(hits).sum(1, dtype=np.int64)
            rows = np.flatnonzero(count)
            block = (hits[rows] != 0).argmax(1)
            first = hits[rows, block]
            bit = block * 64 + np.bitwise_count((first & -first) - np.uint64(1))
            for row, at in zip(rows.tolist(), bit.tolist()):
                yield some[row], int(count[row]), int(n[order[at]]), ranked[at]


def _segments(starts: list[int], ends: list[int], keys: list[tuple], cells: list[int], whole: list[bool], most: int) -> Iterator[list[int]]:
    """Units that may share one index: of one kind of cell, of different cells, none of them cut."""
    held: list[int] = []
    rows = 0
    for u in sorted(range(len(starts)), key=keys.__getitem__):
        size = ends[u] - starts[u]
        joins = held and whole[u] and whole[held[-1]] and keys[u] == keys[held[-1]] and cells[u] != cells[held[-1]]
        if held and not (joins and rows + size <= most):
            yield held
            held, rows = [], 0
        held.append(u)
        rows += size
    if held:
        yield held


def _compared(rows: DataFrame, most: int = 1024) -> DataFrame:
    """(word, near, best_n, best) per word of a unit that has near words there."""
    schema = "word string, near long, best_n long, best string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in grouped(batches, "cell", 16_384):
            words = table.column("word").to_pylist()
            n, cell, chunk, low, high, longest, side = (
                table.column(c).to_numpy() for c in ("n", "cell", "_chunk", "_low", "_high", "longest", "side")
            )
            starts = begins.tolist()
            ends = [*starts[1:], len(words)]
            out: list[tuple] = []
            # Cells are told apart by a hash; the kind of a row is taken from the row itself.
            kinds = [(int(longest[a]), int(side[a])) for a in starts]
            pure = [(longest[a:b] == longest[a]).all() and (side[a:b] == side[a]).all() for a, b in zip(starts, ends)]
            whole = [p and low[a] == high[a] for a, p in zip(starts, pure)]
            for units_ in _segments(starts, ends, kinds, cell[begins].tolist(), whole, most):
                at = np.concatenate([np.arange(starts[u], ends[u]) for u in units_])
                for m, s in sorted({(int(longest[i]), int(side[i])) for i in at.tolist()}):
                    own = at[(longest[at] == m) & (side[at] == s)]
                    if low[own[0]] == high[own[0]]:
                        pairs = [(own, own)]
                    else:
                        left, right = own[chunk[own] == low[own[0]]], own[chunk[own] != low[own[0]]]
                        pairs = [(left, right), (right, left)] if len(left) and len(right) else []
                    for over, asked in pairs:
                        out += _summed([words[i] for i in over], n[over], [words[i] for i in asked], m, s == 0)
            columns = list(zip(*out)) or [()] * 4
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["word", "near", "best_n", "best"]
            )

    return rows.mapInArrow(run, schema)


def near_words(vocabulary: DataFrame, block: int = 2048) -> DataFrame:
    """``vocabulary`` (word, n; each word once, of at least two letters) with n_near, best and best_n.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced letter.  n_near counts a word's near words; best is the one of
    them with the largest n, of equals the first in code-point order.

    If the longer of two near words has M letters, one edit leaves M - 1
    of them in place, so the two share their first or their last M div 2
    letters.  Every word therefore enters four cells: both ends, once as the
    longer or equal and once as the shorter word.  A pair that shares both ends
    counts at the first letters only.  Cells of any size are compared
    chunk against chunk (see ``cells``), small ones together, by bitsets over
    the words of the unit: for each letter of a query the sets of words reached
    without an error, and with one error at the shifts 0, +1 and -1, advance in
    step.  What leaves a unit is at most one row a word.
    """
    size = F.char_length("word")
    ends = [
        F.struct(
            (size + more).cast("int").alias("longest"),
            F.lit(side).alias("side"),
            F.expr(f"{end}(word, (char_length(word) + {more}) div 2)").alias("letters"),
        )
        for more in (0, 1)
        for side, end in enumerate(("left", "right"))
    ]
    members = vocabulary.select("word", "n", F.explode(F.array(*ends)).alias("c")).select(
        "word", "n", "c.longest", "c.side", F.xxhash64("c.longest", "c.side", "c.letters").alias("cell")
    )
    found = _compared(deal(units(members, "cell", "word", block), "cell"))
    better = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    known = vocabulary.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<n:bigint,word:string>").alias("b"))
    hits = found.select("word", F.lit(None).cast("long").alias("n"), "near", better.alias("b"))
    return (
        known.unionByName(hits)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("b").alias("b"))
        .select("word", "n", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))
    )


def roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``(word, root)`` of every word that has a form: the last word on the way from form to form.

    A form occurs more often than its word, so the way ends.  Each round
    doubles the steps made; the joins look for few targets, which adaptive
    execution splits where many words share one.
    """
    now = cut_lineage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    for _ in range(most_rounds):
        further = now.select(dealt_anew(now, "word").alias("_of"), F.col("root").alias("_next"))
        moved = cut_lineage(now.join(further, F.col("root") == F.col("_of"), "left"))
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return now
        now = moved.select("word", F.coalesce("_next", "root").alias("root"))
    raise RuntimeError(f"roots did not settle in {most_rounds} rounds")


def group_variants(vocabulary: DataFrame, ratio: int = 2, block: int = 2048) -> DataFrame:
    """One row per word of ``vocabulary`` (word, n): word, form, root, n, n_near and form_n.

    A word's form is its best near word (see ``near_words``) if that occurs at
    least ``ratio`` times as often, else null; its root is the last word
    reached by following forms, itself if it has none.  n_near is 0 for a word
    without near words.  Null words are left out, words that repeat are added
    up; other columns are ignored, an empty table gives an empty result.
    """
    words = vocabulary.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    near = near_words(cut_lineage(words), block)
    better = F.col("best_n") >= ratio * F.col("n")
    named = cut_lineage(
        near.select("word", "n", "n_near", F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n"))
    )
    ends = roots(named)
    ends = ends.select(F.col("word").alias(own := fresh("_word", named)), "root")
    return named.join(ends, F.col("word") == F.col(own), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, least_letters: int = 5, least_count: int = 3, slip_every: int | None = 97, **options) -> DataFrame:
    """The words of ``docs`` grouped by spelling: ``word_counts``, then ``group_variants``."""
    return group_variants(word_counts(docs, least_letters, least_count, slip_every, **options))
