"""Language of a text by prediction by partial matching: the language whose model codes it shortest."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .batches import pieces, texts
from .files import pack, share, unpack

UNDETERMINED = "und"
ORDER = 3


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves 2 on division by 4.  A null id trains."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def training_sample(
    docs: DataFrame, label: str = "lang", text: str = "text", sample_bytes: int = 2_000_000, piece: int = 4096
) -> dict[str, list[str]]:
    """About ``sample_bytes`` of text for each label, in pieces of ``piece`` characters; all of it where there is less.

    Pieces are drawn by a hash of id, text and place, so the sample is the same
    on every run; a label of few long texts gets its share of each, and no long
    text exceeds it.  One pass sums the bytes of each label, a second one
    keeps the drawn pieces; nothing is sorted or shuffled but the sums.
    """
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out())
    sums = labelled.groupBy(label).agg(F.sum(F.octet_length(text)).alias("bytes")).collect()
    if not sums:
        return {}
    shares = [F.when(F.col("label") == r[label], F.lit(min(1.0, sample_bytes / max(1, r["bytes"])))) for r in sums]
    named = labelled.select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64("doc_id", F.col(text)).alias("name"))
    places = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / piece).cast("int"))
    cut = named.where(F.char_length("text") > 0).withColumn("place", F.explode(places))
    draw = F.pmod(F.xxhash64("name", "place", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    drawn = cut.where(draw < F.coalesce(*shares))
    chosen = drawn.select("label", F.substr(F.col("text"), F.col("place") * piece + 1, F.lit(piece)).alias("text")).collect()
    out: dict[str, list[str]] = {r[label]: [] for r in sums}
    for row in chosen:
        out[row["label"]].append(row["text"])
    return {k: sorted(v) for k, v in sorted(out.items())}


# --- the model


def _contexts(codes: np.ndarray, counts: np.ndarray, size: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of (context of that order, symbol) from those of the highest order."""
    keys, at = np.unique(codes % size ** (order + 1), return_inverse=True)
    return keys // size, keys % size, np.bincount(at, counts).astype(np.float64)


class Model:
    """Cost in bits of every byte after every context, for all languages side by side.

    A language's context tree holds the contexts of up to three bytes of its
    training texts.  A byte that a context has not seen costs an escape to the
    next shorter context, by method C: with n occurrences and q different
    bytes, a byte seen c times has c / (n + q) and the escape q / (n + q).
    Bytes that longer contexts would have coded are excluded below, so the
    probabilities of all bytes sum to one.  Below the empty context, bytes are
    equally likely.  The counts are frozen after training, so the cost of a
    byte depends on the three bytes before it alone and can be tabulated.

    Bytes absent from all training texts share one symbol, and one more stands
    before the beginning of a text.
    """

    def __init__(self, sample: dict[str, list[str]]):
        self.languages = list(sample)
        raw = [[t.encode("utf-8", "surrogatepass") for t in ts] for ts in sample.values()]
        seen = np.zeros(256, bool)
        for ts in raw:
            seen[np.unique(np.frombuffer(b"".join(ts), np.uint8))] = True
        self.symbol = np.zeros(256, np.int64)  # 0: before the text, 1: all unseen bytes
        self.symbol[~seen] = 1
        self.symbol[seen] = np.arange(2, 2 + seen.sum())
        self.size = int(seen.sum()) + 2
        counted = [self._count(ts) for ts in raw]
        self._number([c[0] for c in counted])
        costs = np.stack([self._costs(*c) for c in counted], axis=-1)
        self.costs = costs.reshape(-1, len(self.languages)).astype(np.float32)

    def codes(self, segment: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts with the three symbols before each, and where each text begins."""
        pad = b"\0" * ORDER
        lengths = np.fromiter(map(len, segment), np.int64, len(segment))
        starts = np.cumsum(lengths + ORDER) - lengths
        flat = np.frombuffer(pad + pad.join([*segment, b""]), np.uint8)[: int((lengths + ORDER).sum())]
        sym = self.symbol[flat]
        for k in range(1, ORDER + 1):
            sym[starts - k] = 0
        real = np.ones(len(flat), bool)
        for k in range(1, ORDER + 1):
            real[starts - k] = False
        at = np.flatnonzero(real)
        return sym[at - 3], sym[at - 2], sym[at - 1], sym[at], np.cumsum(lengths) - lengths

    def _count(self, segment: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, s, _ = self.codes(segment)
        return np.unique(((a * self.size + b) * self.size + c) * self.size + s, return_counts=True)

    def _number(self, codes: list[np.ndarray]) -> None:
        """Number the contexts of all languages, and find for any three symbols the longest known one."""
        size = self.size
        self.known = []
        self.base = []
        count = 0
        for order in range(ORDER + 1):
            keys = np.unique(np.concatenate([np.zeros(1, np.int64)] * (order == 0) + [c % size ** (order + 1) // size for c in codes]))
            self.known.append(keys)
            self.base.append(count)
            count += len(keys)
        self.count = count
        state = np.zeros(size**ORDER, np.int32)
        for order in range(ORDER + 1):
            local = np.full(size**order, -1, np.int32)
            local[self.known[order]] = self.base[order] + np.arange(len(self.known[order]))
            wide = np.tile(local, size ** (ORDER - order))
            state = np.where(wide >= 0, wide, state)
        self.state = state.astype(np.int32)

    def _costs(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        size = self.size
        table = np.zeros((self.count, size))
        for order in range(ORDER + 1):
            context, symbol, n = _contexts(codes, counts, size, order)
            table[self.base[order] + np.searchsorted(self.known[order], context), symbol] = n
        # How many bytes a symbol stands for, for the equal shares below the empty context.
        stands = np.ones(size)
        stands[0], stands[1] = 0, max(1, 256 - (size - 2))
        out = np.zeros((self.count, size), np.float32)
        for order in range(ORDER + 1):
            keys = self.known[order]
            rows = self.base[order] + np.arange(len(keys))
            excluded = np.zeros((len(keys), size), bool)
            open_ = np.ones((len(keys), size), bool)
            cost = np.zeros((len(keys), size))
            for shorter in range(order, -1, -1):
                below = self.base[shorter] + np.searchsorted(self.known[shorter], keys % size**shorter)
                seen = np.where(excluded, 0.0, table[below])
                n, q = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
                total = np.maximum(n + q, 1)
                hit = open_ & (seen > 0)
                cost += np.where(hit, -np.log2(np.maximum(seen, 1) / total), 0)
                escape = np.where(q > 0, -np.log2(np.maximum(q, 1) / total), 0)
                open_ &= ~hit
                cost += np.where(open_, escape, 0)
                excluded |= seen > 0
            left = np.where(excluded, 0, stands).sum(1, keepdims=True)
            cost += np.where(open_, np.log2(np.maximum(left, 1)), 0)
            out[rows] = cost
        return out

    def packed(self) -> tuple[bytes, list[tuple]]:
        return pack({"symbol": self.symbol, "state": self.state, "costs": self.costs})

    @classmethod
    def mapped(cls, path: str, layout: list[tuple], languages: list[str], size: int) -> "Model":
        model = cls.__new__(cls)
        model.languages, model.size = languages, size
        for name, array in unpack(path, layout).items():
            setattr(model, name, array)
        model.symbol = np.array(model.symbol)
        return model

    def code_lengths(self, segment: list[bytes]) -> np.ndarray:
        """Bits of every text under every language."""
        out = np.zeros((len(segment), len(self.languages)))
        a, b, c, s, starts = self.codes(segment)
        if len(s):
            state = self.state[(a * self.size + b) * self.size + c].astype(np.int64)
            bits = self.costs[state * self.size + s]
            some = np.fromiter(map(len, segment), np.int64, len(segment)) > 0
            out[some] = np.add.reduceat(bits, starts[some], axis=0, dtype=np.float64)
        return out


# --- on DataFrames

_loaded: dict[str, Model] = {}


def _worker(name: str, layout: list[tuple], languages: list[str], size: int) -> Model:
    if name not in _loaded:
        _loaded.clear()
        _loaded[name] = Model.mapped(SparkFiles.get(name), layout, languages, size)
    return _loaded[name]


def identify(
    docs: DataFrame,
    sample_bytes: int = 2_000_000,
    text: str = "text",
    label: str = "lang",
    name: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language of every whole text and the share of belief in it.

    One model for each value of ``label`` is fitted on the driver from a sample
    of about ``sample_bytes`` of pieces of labelled texts (see ``training_sample``) and
    goes to the executors as one mapped file.  The prediction takes the text
    alone.  ``score`` is the probability of the chosen language if all are
    equally likely beforehand and their code lengths are exact; equal code
    lengths are settled by the order of the names.

    A null text, or one without a letter, is ``und`` with score 0, and so is
    every text if there are no labelled rows.  Repeated rows are kept, an empty
    table gives an empty result, columns named like the added ones are
    replaced.  Nothing is shuffled but the sums of the sample.
    """
    kept = [c for c in docs.columns if c not in (name, score)]
    sample = training_sample(docs, label, text, sample_bytes)
    if not sample:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(UNDETERMINED).alias(name), F.lit(0.0).alias(score))
    model = Model(sample)
    content, layout = model.packed()
    file, languages, size = share(docs.sparkSession, content, "language"), model.languages, model.size
    added = [T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _worker(file, layout, languages, size)
        for piece in pieces(batches, text, 1 << 19):
            segment = texts(piece, text)
            known = np.array([any(map(str.isalpha, t)) for t in segment], bool)
            best, belief = np.zeros(len(segment), np.int64), np.zeros(len(segment))
            if known.any():
                bits = model.code_lengths([t.encode("utf-8", "surrogatepass") for t in segment])
                best = bits.argmin(1)
                belief = 1 / np.exp2(np.minimum(0, bits.min(1, keepdims=True) - bits)).sum(1)
            named = [languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in kept], pa.array(named, pa.string()), pa.array(np.where(known, belief, 0.0))],
                names=[*kept, name, score],
            )

    return docs.mapInArrow(run, schema)
