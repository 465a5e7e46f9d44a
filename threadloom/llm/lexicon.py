"""A minimal acyclic transducer from words to id sequences, in one memory-mapped file.

Words share prefixes and suffixes.  An arc carries a number; the numbers along
a word's path sum to its rank among the sorted words, and the rank selects its
ids.  Because the numbers are sums of what lies below, they keep equal suffixes
equal, so the automaton stays minimal although every word has its own ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class _Builder:
    """Daciuk's construction from sorted words: equal states are merged as soon as they are complete."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.states: list[tuple[bool, tuple]] = []

    def freeze(self, final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.states)
            self.states.append(key)
        return state

    def build(self, words: Sequence[bytes]) -> int:
        # The path of the last word: [final, arcs to frozen states, byte that leads on]
        path: list[list] = [[False, [], None]]
        last = b""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            self._close(path, shared)
            for byte in word[shared:]:
                path[-1][2] = byte
                path.append([False, [], None])
            path[-1][0] = True
            last = word
        self._close(path, 0)
        return self.freeze(path[0][0], path[0][1])

    def _close(self, path: list[list], depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs, _ = path.pop()
            path[-1][1].append((path[-1][2], self.freeze(final, arcs)))


def compile_lexicon(entries: dict[bytes, Sequence[int]], path: str) -> None:
    """Write the transducer of ``entries`` to ``path``."""
    words = sorted(entries)
    builder = _Builder()
    root = builder.build(words)
    below = [0] * len(builder.states)
    keys, targets, adds = [], [], []
    # States are frozen after all states that they lead to.
    for state, (final, arcs) in enumerate(builder.states):
        passed = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(passed)
            passed += below[target]
        below[state] = passed
    ids = [np.asarray(entries[w], np.int64) for w in words]
    ends = np.cumsum([0, *map(len, ids)])
    final = np.array([f for f, _ in builder.states], np.int64)
    parts = [
        np.array([root, len(keys), len(final), len(ends), int(ends[-1])], np.int64),
        np.array(keys, np.int64), np.array(targets, np.int64), np.array(adds, np.int64),
        final, ends.astype(np.int64), np.concatenate([np.zeros(0, np.int64), *ids]),
    ]
    with open(path, "wb") as out:
        for part in parts:
            out.write(part.astype("<i8").tobytes())


class Lexicon:
    """The mapped file; look-ups of many words advance together, one byte a step."""

    def __init__(self, path: str):
        whole = np.memmap(path, dtype="<i8", mode="r")
        self.root, arcs, states, ends, ids = (int(x) for x in whole[:5])
        cut = np.cumsum([5, arcs, arcs, arcs, states, ends, ids])
        self.keys, self.targets, self.adds, self.final, self.ends, self.ids = (
            whole[a:b] for a, b in zip(cut[:-1], cut[1:])
        )

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """Rank of each word, -1 for words outside the lexicon."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        rank = np.zeros(len(words), np.int64)
        state = np.full(len(words), self.root, np.int64)
        alive = np.ones(len(words), bool) if len(self.keys) else np.zeros(len(words), bool)
        going, step = np.flatnonzero(alive & (lengths > 0)), 0
        while len(going):
            wanted = state[going] << 8 | flat[starts[going] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            alive[going[~hit]] = False
            going, at = going[hit], at[hit]
            state[going] = self.targets[at]
            rank[going] += self.adds[at]
            step += 1
            going = going[lengths[going] > step]
        found = alive & (self.final[state] == 1) if len(self.final) else alive
        return np.where(found, rank, -1)

    def output(self, rank: int) -> np.ndarray:
        return self.ids[self.ends[rank] : self.ends[rank + 1]]
