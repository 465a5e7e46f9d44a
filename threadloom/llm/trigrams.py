"""Boolean trigram queries derived from regular expressions, and the index that answers them.

A query is ``ALL`` (nothing is known), ``("and", parts)``, ``("or", parts)`` or
a trigram.  Letters are folded to lower case in queries and in the index, so a
query asks for no more than its expression does, whatever its flags.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from re import _constants as op, _parser

import numpy as np

ALL = "all"
MOST = 48  # strings kept apart before they become a query


def both(*parts):
    flat = {p for part in parts for p in (part[1] if part[0] == "and" else (part,)) if p != ALL}
    if not flat:
        return ALL
    return next(iter(flat)) if len(flat) == 1 else ("and", frozenset(flat))


def either(*parts):
    flat = {p for part in parts for p in (part[1] if part[0] == "or" else (part,))}
    if ALL in flat or not flat:
        return ALL
    return next(iter(flat)) if len(flat) == 1 else ("or", frozenset(flat))


def of_strings(strings: Iterable[str]):
    """Some of the strings occurs."""
    return either(*[both(*[("tri", s[i : i + 3]) for i in range(len(s) - 2)]) for s in strings])


@dataclass
class _Known:
    """What an expression's matches are known to be (``exact``), begin, end and contain."""

    exact: frozenset | None = None
    prefix: frozenset = frozenset({""})
    suffix: frozenset = frozenset({""})
    empty: bool = False
    query: object = field(default=ALL)

    def settled(self) -> "_Known":
        """Large sets and long ends become part of the query."""
        if self.exact is not None:
            if len(self.exact) <= MOST:
                return self
            query = both(self.query, of_strings(self.exact))
            self = _Known(None, self.exact, self.exact, "" in self.exact, query)
        query = both(self.query, of_strings(self.prefix), of_strings(self.suffix))
        prefix, suffix = frozenset(s[:2] for s in self.prefix), frozenset(s[-2:] for s in self.suffix)
        blank = frozenset({""})
        return _Known(None, prefix if len(prefix) <= MOST else blank, suffix if len(suffix) <= MOST else blank, self.empty, query)

    def full(self):
        strings = self.exact if self.exact is not None else None
        return both(self.query, of_strings(strings)) if strings is not None else self.settled().query


def _ends(known: _Known) -> tuple[frozenset, frozenset]:
    return (known.exact, known.exact) if known.exact is not None else (known.prefix, known.suffix)


def _join(x: _Known, y: _Known) -> _Known:
    if x.exact is not None and y.exact is not None:
        exact = frozenset(a + b for a in x.exact for b in y.exact)
        return _Known(exact, empty=x.empty and y.empty, query=both(x.query, y.query)).settled()
    xp, xs = _ends(x)
    yp, ys = _ends(y)
    prefix = frozenset(a + b for a in xp for b in yp) if x.exact is not None else (xp | yp if x.empty else xp)
    suffix = frozenset(a + b for a in xs for b in ys) if y.exact is not None else (xs | ys if y.empty else ys)
    across = of_strings(a + b for a in xs for b in yp)
    return _Known(None, prefix, suffix, x.empty and y.empty, both(x.full(), y.full(), across)).settled()


def _or(x: _Known, y: _Known) -> _Known:
    empty = x.empty or y.empty
    if x.exact is not None and y.exact is not None:
        return _Known(x.exact | y.exact, empty=empty, query=either(x.query, y.query)).settled()
    (xp, xs), (yp, ys) = _ends(x), _ends(y)
    return _Known(None, xp | yp, xs | ys, empty, either(x.full(), y.full())).settled()


NOTHING = frozenset({""})


def _char(points: Iterable[int] | None) -> _Known:
    """One of a few known characters; any other character breaks what is known."""
    if points is None:
        return _Known()
    strings = set()
    for point in points:
        if point > 127:
            return _Known()
        strings.add(chr(point).lower())
        if len(strings) > 8:
            return _Known()
    return _Known(frozenset(strings)) if strings else _Known()


def _class(items) -> list[int] | None:
    points: list[int] = []
    for kind, value in items:
        if kind is op.LITERAL:
            points.append(value)
        elif kind is op.RANGE and value[1] - value[0] < 64:
            points += range(value[0], value[1] + 1)
        else:
            return None
    return points


def _walk(tree) -> _Known:
    known = _Known(NOTHING, empty=True)
    for kind, value in tree:
        known = _join(known, _node(kind, value))
    return known


def _node(kind, value) -> _Known:
    if kind is op.LITERAL:
        return _char([value])
    if kind is op.IN:
        return _char(_class(value))
    if kind in (op.ANY, op.NOT_LITERAL):
        return _Known()
    if kind is op.SUBPATTERN:
        return _walk(value[3])
    if kind is op.ATOMIC_GROUP:
        return _walk(value)
    if kind is op.BRANCH:
        known, *rest = [_walk(branch) for branch in value[1]]
        for other in rest:
            known = _or(known, other)
        return known
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, tree = value
        inner = _walk(tree)
        if (least, most) == (0, 1):
            return _or(_Known(NOTHING, empty=True), inner)
        known = _Known(NOTHING, empty=True)
        for _ in range(min(least, 4)):
            known = _join(known, inner)
        if most == least <= 4:
            return known
        return _join(known, _Known(empty=True)) if known.exact != NOTHING else _Known(empty=True)
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return _Known(NOTHING, empty=True)
    return _Known(empty=True)  # back references, conditions: anything


def trigram_query(pattern: str, flags: int = 0):
    """The query every text with a match satisfies; ``ALL`` if the expression has no mandatory trigram."""
    return _walk(_parser.parse(pattern, flags)).full()


def trigrams_of(query) -> set[str]:
    if query == ALL:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams_of, query[1]))


class Index:
    """Postings of the wanted trigrams over a segment of texts.

    Bytes that no wanted trigram holds share one symbol, so that a trigram is a
    small number and one table look-up per byte finds the wanted ones.
    """

    def __init__(self, wanted: Iterable[str]):
        self.wanted = sorted(wanted)
        letters = sorted({ord(c) for t in self.wanted for c in t})
        self.symbol = np.zeros(256, np.uint32)
        for i, byte in enumerate(letters, 1):
            for same in {byte, ord(chr(byte).upper())}:
                self.symbol[same] = i
        self.bits = max(1, len(letters).bit_length())
        self.slot = np.zeros(1 << 3 * self.bits, np.uint16)
        for i, trigram in enumerate(self.wanted, 1):
            a, b, c = (int(self.symbol[ord(x)]) for x in trigram)
            self.slot[(a << 2 * self.bits) | (b << self.bits) | c] = i

    def postings(self, segment: Sequence[bytes]) -> dict[str, np.ndarray]:
        """For each wanted trigram the sorted numbers of the texts that hold it."""
        flat = np.frombuffer(b"\xff\xff".join([*segment, b""]), np.uint8)
        ends = np.cumsum([len(s) + 2 for s in segment])
        symbol = self.symbol[flat]
        code = (symbol[:-2] << 2 * self.bits) | (symbol[1:-1] << self.bits) | symbol[2:] if len(flat) > 2 else symbol[:0]
        slot = self.slot[code]
        at = np.flatnonzero(slot)
        pairs = np.unique(slot[at].astype(np.int64) * (len(segment) + 1) + np.searchsorted(ends, at, "right"))
        which, text = np.divmod(pairs, len(segment) + 1)
        cuts = np.searchsorted(which, np.arange(1, len(self.wanted) + 2))
        return {t: text[cuts[i] : cuts[i + 1]] for i, t in enumerate(self.wanted)}


def candidates(query, postings: dict[str, np.ndarray], texts: int) -> np.ndarray:
    """Numbers of the texts that satisfy the query."""
    if query == ALL:
        return np.arange(texts)
    if query[0] == "tri":
        return postings[query[1]]
    found = [candidates(part, postings, texts) for part in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(found))
    found.sort(key=len)
    out = found[0]
    for other in found[1:]:
        if not len(out):
            break
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def compile_pattern(pattern: str, flags: int = 0) -> re.Pattern:
    return re.compile(pattern, flags | re.ASCII)
