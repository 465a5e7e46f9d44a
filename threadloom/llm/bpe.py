"""Byte-level BPE: a word lexicon for frequent words, exact merges for all others, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage
from .batches import pieces, texts
from .files import share
from .lexicon import Lexicon, compile_lexicon

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
NONE = np.int64(1 << 40)


# --- splitting into words


def _class_of(char: str, split) -> int:
    """Found out from the tokenizer's own splitter, whose Unicode tables may differ from Python's."""
    for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        if len(split(mate + char)) == 1:
            return kind
    return SPACE


class Splitter:
    """Word boundaries of the byte-level pattern, for many texts at once.

    The pattern takes, in this order: a contraction, letters, digits or other
    signs with one leading blank, blanks but for the last one before a word,
    blanks.  So boundaries lie where the class changes, apart from the last
    blank of a run and from contractions.
    """

    def __init__(self):
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        kinds = self.classes[points]
        if (new := np.unique(points[kinds == UNKNOWN])).size:
            from tokenizers.pre_tokenizers import ByteLevel

            split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
            for point in new:
                self.classes[point] = _class_of(chr(point), split)
            kinds = self.classes[points]
        return kinds

    def words(self, batch: Sequence[str]) -> tuple[list[str], np.ndarray]:
        """All words of the texts, and where each text's words begin (one more entry at the end)."""
        joined = "".join(batch)
        lengths = np.fromiter(map(len, batch), np.int64, len(batch))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        n = len(points)
        if not n:
            return [], np.zeros(len(batch) + 1, np.int64)
        kinds = self._kinds(points)
        fresh = np.zeros(n + 1, bool)  # a text begins here
        fresh[bounds] = True
        starts = fresh[:n].copy()
        starts[1:] |= kinds[1:] != kinds[:-1]
        run = np.flatnonzero(starts)
        end = np.append(run[1:], n)
        kind = kinds[run]
        attached = np.zeros(n + 1, bool)
        blanks = end[(kind == SPACE) & ~fresh[end]]
        starts[blanks - 1] = True
        leading = blanks[points[blanks - 1] == 32]
        starts[leading] = False
        attached[leading] = True
        # A lone apostrophe before letters may begin a contraction.
        lone = run[(kind == OTHER) & (end == run + 1) & (points[run] == 39) & ~attached[run] & ~fresh[end]]
        lone = lone[kinds[lone + 1] == LETTER]
        first = points[lone + 1]
        last = np.minimum(lone + 2, n - 1)
        second = np.where((lone + 2 < n) & ~fresh[lone + 2], points[last], 0)
        short = np.isin(first, [ord(c) for c in "stmd"])
        e, ll = second == ord("e"), second == ord("l")
        long = (e & np.isin(first, [ord("r"), ord("v")])) | (ll & (first == ord("l")))
        for chosen, size in ((short, 2), (long & ~short, 3)):
            at = lone[chosen]
            starts[at + 1] = False
            after = at + size
            starts[after[after < n]] = True
        begin = np.flatnonzero(starts)
        stop = np.append(begin[1:], n)
        words = [joined[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
        return words, np.searchsorted(begin, bounds)


# --- the tables of a tokenizer file


class Tables:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        model = loaded["model"]
        vocab = model["vocab"]
        # Printable bytes stand for themselves, the others for the code points from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        sign = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        byte = {c: b for b, c in sign.items()}
        self.special = {t["content"]: t["id"] for t in loaded.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for text, number in vocab.items():
            self.token[number] = bytes(byte[c] for c in text)
        for text, number in self.special.items():
            self.token[number] = text.encode()
        self.base = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = size
        keys = left * size + right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], NONE)


# --- merging


def merge_words(words: Sequence[bytes], tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words behind one another, and where each word's end.  Every round applies, in all words at once, each word's best merge.

    A token's own merge ranks before all merges it takes part in, so applying
    all places of the best pair together equals applying them from left to
    right.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sym = tables.base[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    done_sym, done_word = [], []
    while len(sym):
        rank = np.full(len(sym), NONE)
        rank[:-1] = tables.ranks(sym[:-1] * tables.size + sym[1:])
        change = word[1:] != word[:-1]
        rank[:-1][change] = NONE
        first = np.flatnonzero(np.append(True, change))
        best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
        ended = best == NONE
        if ended.any():
            done_sym.append(sym[ended])
            done_word.append(word[ended])
            sym, word, rank, best = (x[~ended] for x in (sym, word, rank, best))
            if not len(sym):
                break
        hit = rank == best
        # Neighbouring places of one pair overlap: every second one of a run is taken.
        place = np.arange(len(sym))
        before = np.maximum.accumulate(np.where(hit, -1, place))
        hit &= (place - before) % 2 == 1
        sym[hit] = tables.made[rank[hit]]
        keep = np.append(True, ~hit[:-1])
        sym, word = sym[keep], word[keep]
    ids = np.concatenate([np.zeros(0, np.int64), *done_sym])
    owner = np.concatenate([np.zeros(0, np.int64), *done_word])
    order = np.argsort(owner, kind="stable")
    return ids[order], np.cumsum(np.bincount(owner, minlength=len(words)))


def merge_long(word: bytes, tables: Tables) -> np.ndarray:
    """Ids of one very long word: a queue of merges by rank and place."""
    sym = tables.base[np.frombuffer(word, np.uint8)].tolist()
    n = len(sym)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    made, size = tables.made.tolist(), tables.size

    def rank(a: int, b: int) -> int:
        return int(tables.ranks(np.array([a * size + b]))[0])

    first = tables.ranks(np.array(sym[:-1]) * size + np.array(sym[1:])).tolist()
    queue = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r != NONE]
    heapq.heapify(queue)
    while queue:
        r, i, a, b = heapq.heappop(queue)
        j = right[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue
        sym[i], sym[j] = made[r], -1
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y >= 0 and (r := rank(sym[x], sym[y])) != NONE:
                heapq.heappush(queue, (r, x, sym[x], sym[y]))
    return np.array([s for s in sym if s >= 0], np.int64)


class Encoder:
    """Encodes texts; one per Python worker.

    ``memory`` bounds the words whose ids are kept between batches.  Words of
    more than ``LONG`` bytes are merged by themselves and not kept.
    """

    LONG = 512

    def __init__(self, tables: Tables, lexicon: Lexicon | None, memory: int = 200_000):
        self.tables, self.lexicon, self.memory = tables, lexicon, memory
        self.splitter = Splitter()
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        ranks = self.lexicon.ranks(raw) if self.lexicon else np.full(len(raw), -1)
        merged = []
        for i, rank in enumerate(ranks.tolist()):
            if rank >= 0:
                self.known[new[i]] = self.lexicon.output(rank).astype("<u4").tobytes()
            elif len(raw[i]) > self.LONG:
                self.known[new[i]] = merge_long(raw[i], self.tables).astype("<u4").tobytes()
            else:
                merged.append(i)
        if merged:
            ids, ends = merge_words([raw[i] for i in merged], self.tables)
            flat, at = ids.astype("<u4").tobytes(), 0
            for i, end in zip(merged, (4 * ends).tolist()):
                self.known[new[i]] = flat[at:end]
                at = end

    def _plain(self, batch: Sequence[str]) -> list[bytes]:
        if len(self.known) > self.memory:
            self.known.clear()
        words, bounds = self.splitter.words(batch)
        if new := set(words).difference(self.known):
            self._learn(list(new))
        ids = list(map(self.known.__getitem__, words))
        for word in [w for w in new if len(w) > self.LONG]:
            del self.known[word]
        cut = bounds.tolist()
        return [b"".join(ids[a:b]) for a, b in zip(cut[:-1], cut[1:])]

    def encode(self, batch: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        The strings of special tokens become their ids, as the library's default has it.
        """
        special = self.tables.special
        odd = [i for i, t in enumerate(batch) if any(s in t for s in special)]
        if not odd:
            return self._plain(batch)
        plain = list(batch)
        cut: dict[int, list] = {}
        for i in odd:
            cut[i] = self._segments(plain[i])
            plain[i] = ""
        out = self._plain(plain)
        for i, parts in cut.items():
            encoded = iter(self._plain([p for p in parts if isinstance(p, str)]))
            out[i] = b"".join(next(encoded) if isinstance(p, str) else p.to_bytes(4, "little") for p in parts)
        return out

    def _segments(self, text: str) -> list:
        parts, at = [], 0
        while True:
            found = [(p, -len(s), s) for s in self.tables.special if (p := text.find(s, at)) >= 0]
            if not found:
                return [*parts, text[at:]]
            start, _, token = min(found)
            parts += [text[at:start], self.tables.special[token]]
            at = start + len(token)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian ids; bytes that are no UTF-8 become the replacement sign."""
        table, step = self.tables.token, 4 << 20
        raw = b"".join(
            b"".join(map(table.__getitem__, np.frombuffer(ids[a : a + step], "<u4").tolist()))
            for a in range(0, len(ids), step)
        )
        return raw.decode("utf-8", "replace")


# --- on DataFrames

_loaded: dict[str, Encoder] = {}


def _worker(tables_file: str, lexicon_file: str) -> Encoder:
    """The worker's encoder; both files came with the job.  The lexicon is mapped, the tables are read once a worker."""
    if lexicon_file not in _loaded:
        _loaded.clear()
        _loaded[lexicon_file] = Encoder(Tables(SparkFiles.get(tables_file)), Lexicon(SparkFiles.get(lexicon_file)))
    return _loaded[lexicon_file]


def frequent_words(docs: DataFrame, text: str = "text", most: int = 32_768, held: int = 200_000) -> list[str]:
    """The ``most`` most frequent words, counted over all rows.

    They decide only which words are looked up and which are merged, never an
    id.  A task hands on its counts whenever it holds ``held`` different words.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = Splitter(), Counter()

        def made() -> pa.RecordBatch:
            columns = {"word": list(seen), "n": pa.array(seen.values(), pa.int64())}
            return pa.RecordBatch.from_pydict(columns, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

        for piece in pieces(batches, text):
            words = splitter.words(texts(piece, text))[0]
            if max(map(len, words), default=0) > 64:
                words = [w for w in words if len(w) <= 64]
            seen.update(words)
            if len(seen) > held:
                yield made()
                seen.clear()
        yield made()

    counted = docs.select(text).mapInArrow(count, "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "word").limit(most)
    # Collected as it is, every task would send its ``most`` words to the driver.
    return [r["word"] for r in cut_lineage(top.select("word")).collect()]


_KINDS = {
    "token_ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("long", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def encode(
    docs: DataFrame,
    tokenizer: str,
    outputs: Sequence[str] = ("token_ids", "n_tokens"),
    keep: Sequence[str] | None = None,
    text: str = "text",
    lexicon_words: int = 32_768,
) -> DataFrame:
    """``docs`` with the BPE ids of every whole text.

    ``tokenizer`` is the path of a byte-level BPE file on the driver.  Its
    tables and a lexicon of the corpus's frequent words, compiled into a
    minimal acyclic transducer, go to the executors as files; the lexicon is
    memory-mapped there.  All other words are merged exactly.

    ``outputs`` names the added columns: token_ids, n_tokens, decoded (the text
    that the ids give back), and the SHA-256 digests ids_sha256 (of
    little-endian 32-bit ids) and decoded_sha256.  ``keep`` names the columns
    of ``docs`` to keep (default: all but those of the added names).

    A null text counts as empty, an empty text has no ids, repeated rows are
    kept, an empty table gives an empty result.  The texts are read twice: the
    words of all of them are counted for the lexicon first.  Nothing is shuffled
    but these counts.
    """
    spark = docs.sparkSession
    tables = Tables(tokenizer)
    words = frequent_words(docs, text, lexicon_words)
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    ids, ends = merge_words(raw, tables)
    folder = tempfile.mkdtemp(prefix="threadloom-")
    compile_lexicon(dict(zip(raw, np.split(ids, ends[:-1]))), os.path.join(folder, "lexicon"))
    with open(os.path.join(folder, "lexicon"), "rb") as file:
        lexicon_file = share(spark, file.read(), "bpe-lexicon")
    with open(tokenizer, "rb") as file:
        tables_file = share(spark, file.read(), "bpe-tables")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType(fields + [T.StructField(n, T._parse_datatype_string(_KINDS[n][0])) for n in outputs])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(tables_file, lexicon_file)
        for piece in pieces(batches, text):
            coded = encoder.encode(texts(piece, text))
            made = {}
            if "token_ids" in outputs:
                ends = np.cumsum([0, *[len(c) // 4 for c in coded]]).astype(np.int32)
                flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                made["token_ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            if "n_tokens" in outputs:
                made["n_tokens"] = pa.array([len(c) // 4 for c in coded], pa.int64())
            if "ids_sha256" in outputs:
                made["ids_sha256"] = pa.array([hashlib.sha256(c).hexdigest() for c in coded])
            if "decoded" in outputs or "decoded_sha256" in outputs:
                back = [encoder.decode(c) for c in coded]
                made["decoded"] = pa.array(back, pa.string())
                made["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back])
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in kept] + [made[n] for n in outputs], names=[*kept, *outputs]
            )

    source = docs.select(*kept, *([] if text in kept else [text]))
    return source.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its id arrays; null ids give null, an id outside the vocabulary is an error."""
    spark = df.sparkSession
    with open(tokenizer, "rb") as file:
        tables_file = share(spark, file.read(), "bpe-tables")
    columns = [c for c in df.columns if c != name]
    schema = T.StructType([*[df.schema[c] for c in columns], T.StructField(name, T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Tables(SparkFiles.get(tables_file)), None)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            back = [None if x is None else encoder.decode(np.array(x, "<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(back, pa.string())], names=[*columns, name])

    return df.select(*columns).mapInArrow(run, schema)
