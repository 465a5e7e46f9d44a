"""Word-piece lengths by a linear longest-match automaton that counts pieces without building them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, types as T

from .batches import pieces, texts
from .files import pack, share, unpack

WORD = re.compile(r"[^\W_]+|[^\w\s]|_")


def split_words(text: str) -> list[str]:
    """Runs of letters and digits; every other sign but white space is a word of its own."""
    return WORD.findall(text)


def vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces that begin a word and pieces that continue one, from a byte-level BPE file.

    A token with a leading blank begins a word, one without blanks continues
    one.  Single bytes do both, so that every word has pieces.
    """
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    raw = [bytes(byte[c] for c in token) for token in vocab]
    single = [bytes([b]) for b in range(256)]
    initial = {t[1:] for t in raw if t[:1] == b" " and len(t) > 1 and t[1:].strip() == t[1:]}
    inside = {t for t in raw if t.strip() == t and b" " not in t and t}
    return sorted(initial | set(single)), sorted(inside | set(single))


class Automaton:
    """A trie of the pieces with failure links and the number of pieces each link pops.

    Node 0 is the root of words, node 1 that of continuations.  A failing node
    pops the pieces that longest match would have taken on the way to it, and
    goes on at its link; that number is all a length needs.  ``fail`` is -1
    where no split exists: then the word is unknown.
    """

    def __init__(self, initial: Sequence[bytes], inside: Sequence[bytes]):
        children: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        for root, group in ((0, initial), (1, inside)):
            for piece in group:
                node = root
                for b in piece:
                    if b not in children[node]:
                        children[node][b] = len(children)
                        children.append({})
                        ends.append(False)
                    node = children[node][b]
                ends[node] = ends[node] or node > 1
        fail, popped = [-1] * len(children), [0] * len(children)
        queue = [0, 1]
        for parent in queue:
            for b, node in children[parent].items():
                queue.append(node)
                if ends[node]:
                    fail[node], popped[node] = 1, 1
                    continue
                at, count = fail[parent], popped[parent]
                while at >= 0 and b not in children[at]:
                    count += popped[at]
                    at = fail[at]
                if at >= 0:
                    fail[node], popped[node] = children[at][b], count
        arcs = sorted((node << 8 | b, target) for node, below in enumerate(children) for b, target in below.items())
        self.keys = np.array([k for k, _ in arcs], np.int64)
        self.targets = np.array([t for _, t in arcs], np.int32)
        self.fail, self.popped = np.array(fail, np.int32), np.array(popped, np.int32)

    def packed(self) -> tuple[bytes, list[tuple]]:
        return pack({n: getattr(self, n) for n in ("keys", "targets", "fail", "popped")})

    @classmethod
    def mapped(cls, path: str, layout: list[tuple]) -> "Automaton":
        machine = cls.__new__(cls)
        for name, array in unpack(path, layout).items():
            setattr(machine, name, array)
        return machine

    def _pop(self, going: np.ndarray, node: np.ndarray, count: np.ndarray) -> None:
        count[going] += self.popped[node[going]]
        node[going] = self.fail[node[going]]

    def lengths(self, words: Sequence[bytes]) -> np.ndarray:
        """Number of pieces of each word, 0 for words without a split.  All words advance together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        node, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        going, step = np.flatnonzero(sizes > 0), 0
        while len(going):
            here, stuck = flat[starts[going] + step], np.arange(len(going))
            while len(stuck):
                wanted = node[going[stuck]] << 8 | here[stuck]
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                hit = self.keys[at] == wanted
                node[going[stuck[hit]]] = self.targets[at[hit]]
                stuck = stuck[~hit]
                self._pop(going[stuck], node, count)
                stuck = stuck[node[going[stuck]] >= 0]
            step += 1
            going = going[(node[going] >= 0) & (sizes[going] > step)]
        open_ = np.flatnonzero((node > 1) & (sizes > 0))
        while len(open_):
            self._pop(open_, node, count)
            open_ = open_[node[open_] > 1]
        return np.where(node == 1, count, 0)


class Counter:
    """Counts pieces of texts; ``memory`` bounds the words kept between batches."""

    def __init__(self, machine: Automaton, memory: int = 400_000):
        self.machine, self.memory = machine, memory
        self.known: dict[str, int] = {}

    def count(self, batch: Sequence[str]) -> list[tuple[int, int, int]]:
        """Words, tokens and unknown words of each text; an unknown word is one token."""
        if len(self.known) > self.memory:
            self.known.clear()
        split = [split_words(t) for t in batch]
        new = list({w for words in split for w in words}.difference(self.known))
        if new:
            raw = [w.encode("utf-8", "surrogatepass") for w in new]
            self.known.update(zip(new, self.machine.lengths(raw).tolist()))
        out = []
        for words in split:
            lengths = list(map(self.known.__getitem__, words))
            unknown = lengths.count(0)
            out.append((len(words), sum(lengths) + unknown, unknown))
        for word in [w for w in new if len(w) > 256]:
            del self.known[word]
        return out


_loaded: dict[str, Counter] = {}


def _worker(name: str, layout: list[tuple]) -> Counter:
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Counter(Automaton.mapped(SparkFiles.get(name), layout))
    return _loaded[name]


COLUMNS = ("n_words", "n_tokens", "n_unknown")


def count_tokens(docs: DataFrame, initial: Sequence[bytes], inside: Sequence[bytes], text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_tokens and n_unknown of every whole text.

    Words (see ``split_words``) are split into pieces by greedy longest match:
    the longest piece of ``initial`` that begins the word, then the longest of
    ``inside`` over and over.  A word without such a split is one unknown
    token.  A null or empty text has no words; repeated rows are kept; an empty
    table gives an empty result; columns named like the added ones are
    replaced.  Nothing is shuffled.
    """
    content, layout = Automaton(initial, inside).packed()
    name = share(docs.sparkSession, content, "wordpiece")
    kept = [c for c in docs.columns if c not in COLUMNS]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in COLUMNS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker(name, layout)
        for piece in pieces(batches, text):
            made = np.array(counter.count(texts(piece, text)), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in kept], *[pa.array(np.ascontiguousarray(made[:, i])) for i in range(3)]],
                names=[*kept, *COLUMNS],
            )

    return docs.mapInArrow(run, schema)
