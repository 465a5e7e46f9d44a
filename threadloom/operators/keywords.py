"""Many keywords at once: one pass of an automaton over every text."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T


class KeywordAutomaton:
    """Goto, failure and output links over the letters of all keywords (Aho and Corasick, 1975).

    A text is read once, whatever the number of keywords.  Failure moves are
    worked into the goto tables as they are met, so a letter costs one look-up.
    """

    def __init__(self, keywords: Sequence[str]):
        self.keywords = list(dict.fromkeys(keywords))
        self.goto: list[dict[str, int]] = [{}]
        self.own: list[int] = [-1]  # the keyword that ends at a state
        for number, keyword in enumerate(self.keywords):
            at = 0
            for letter in keyword:
                if letter not in self.goto[at]:
                    self.goto[at][letter] = len(self.goto)
                    self.goto.append({})
                    self.own.append(-1)
                at = self.goto[at][letter]
            self.own[at] = number
        self.fail = [0] * len(self.goto)
        self.output = [-1] * len(self.goto)  # the nearest state along the failure links at which a keyword ends
        waiting = deque(self.goto[0].values())
        while waiting:
            at = waiting.popleft()
            for letter, to in self.goto[at].items():
                back = self.fail[at]
                while back and letter not in self.goto[back]:
                    back = self.fail[back]
                self.fail[to] = self.goto[back].get(letter, 0)
                waiting.append(to)
            self.output[at] = self.fail[at] if self.own[self.fail[at]] >= 0 else self.output[self.fail[at]]
        self.start = frozenset(self.goto[0])
        self.moves = [dict(g) for g in self.goto]

    def _step(self, at: int, letter: str) -> int:
        back = at
        while back and letter not in self.goto[back]:
            back = self.fail[back]
        to = self.moves[at][letter] = self.goto[back].get(letter, 0)
        return to

    def ends(self, text: str) -> Iterator[int]:
        """The numbers of the keywords, once for each place where one ends."""
        moves, own, output, start = self.moves, self.own, self.output, self.start
        at = 0
        for letter in text:
            if not at and letter not in start:
                continue
            to = moves[at].get(letter)
            at = self._step(at, letter) if to is None else to
            if own[at] >= 0:
                yield own[at]
            found = output[at]
            while found >= 0:
                yield own[found]
                found = output[found]

    def found(self, text: str) -> list[int]:
        """The numbers of all keywords in a text, in order."""
        return sorted(set(self.ends(text)))

    def any(self, text: str) -> bool:
        return next(self.ends(text), None) is not None


def keyword_hits(df: DataFrame, keywords: Iterable[str], column: str = "title", name: str = "keywords") -> DataFrame:
    """``df`` with an array of the keywords that the lower-cased text holds as substrings, in the order given.

    The keywords go to the tasks with the job; they are a list that the caller
    has.  Empty keywords are in every text, null texts hold none.  Nothing is
    shuffled.  A column called ``name`` is replaced.
    """
    listed = list(dict.fromkeys(keywords))
    made: list[KeywordAutomaton] = []

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def hits(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(KeywordAutomaton([k for k in listed if k]))
        automaton = made[0]
        empty = [""] if "" in listed else []
        rank = {k: i for i, k in enumerate(listed)}
        out = []
        for text in texts.to_pylist():
            found = [] if text is None else empty + [automaton.keywords[i] for i in automaton.found(text)]
            out.append(sorted(found, key=rank.__getitem__))
        return pa.array(out, pa.list_(pa.string()))

    return df.withColumn(name, hits(F.lower(F.col(column))))


def holds_keyword(df: DataFrame, keywords: Iterable[str], column: str = "title") -> DataFrame:
    """Rows whose lower-cased text holds any keyword as a substring; the automaton stops at the first."""
    listed = list(dict.fromkeys(keywords))
    made: list[KeywordAutomaton] = []

    @F.arrow_udf(T.BooleanType())
    def holds(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(KeywordAutomaton([k for k in listed if k]))
        always = "" in listed
        return pa.array([t is not None and (always or made[0].any(t)) for t in texts.to_pylist()], pa.bool_())

    return df.where(holds(F.lower(F.col(column))))
