"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.dedup import _hashable
from ..operators.sizing import dealt_anew
from ..session import cut_lineage
from .batches import fresh, pieces, texts
from .cells import deal, forest, grouped, units
from .components import components

BITS = 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64 majority bits over the hashes of all word shingles, repeats included; 0 for no words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):  # a very long text in parts
        some = range(at, min(at + (1 << 16), count))
        if len(words) < shingle:
            hashes = [digest(b" ".join(words), seed)]
        else:
            part = words[at : some.stop + shingle - 1]
            hashes = [digest(s, seed) for s in map(b" ".join, zip(*[part[k:] for k in range(shingle)]))]
        packed = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(packed, axis=1, bitorder="little")
        for row in range(0, len(bits), 255):  # sums of up to 255 fit a byte
            ones += bits[row : row + 255].sum(axis=0, dtype=np.uint8)
    return sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, fp)`` of every row; ``fp`` holds the 64 bits in a signed long."""
    schema = T.StructType([*[docs.schema[c] for c in (doc_id, *keep)], T.StructField("fp", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text):
            made = [fingerprint(t, shingle, seed) for t in texts(piece, text)]
            signed = np.array(made, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*map(piece.column, (doc_id, *keep)), pa.array(signed)], names=[doc_id, *keep, "fp"])

    return docs.select(doc_id, *keep, text).mapInArrow(run, schema)


def covering_masks(radius: int = 3) -> list[int]:
    """Bit masks such that any two words within ``radius`` bits agree on all of some mask.

    Every bit has a label, a nonzero vector of ``radius + 1`` bits.  Mask ``v``
    holds the bits whose label has an odd product with ``v``.  The labels of at
    most ``radius`` differing bits do not span the space, so some nonzero ``v``
    is orthogonal to all of them, and its mask avoids these bits.  Labels are
    dealt in turn, so that all masks are about equally long.
    """
    vectors = range(1, 1 << radius + 1)
    label = [1 + i % len(vectors) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (label[i] & v).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints connected by links of at most ``radius`` bits.

    ``distinct`` holds each fingerprint once, in ``fp``.  A fingerprint goes to
    one cell per mask.  In each unit of a cell all pairs are compared, but only
    the edges of a spanning forest leave it: at most one per row.  Edges may repeat.
    """
    masks = F.array(*[
        F.struct(F.lit(i).alias("table"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(covering_masks(radius))
    ])
    # Table and masked bits together make the cell; unequal cells that share a hash are told apart by the comparison.
    keyed = distinct.select("fp", F.explode(masks).alias("m")).select(
        "fp", F.xxhash64(F.col("m.table"), F.col("fp").bitwiseAND(F.col("m.mask"))).alias("cell")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in grouped(batches, "cell"):
            fps = table.column("fp").to_numpy().view(np.uint64)
            left, right = _edges(fps, np.append(starts, len(fps)), radius)
            yield pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], names=["a", "b"])

    dealt = deal(units(keyed, "cell", "fp", block), "cell")
    return dealt.mapInArrow(run, "a long, b long")


SMALL = 24


def _edges(fps: np.ndarray, bounds: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all units of a run; small units advance together, large ones by themselves."""
    sizes = np.diff(bounds)
    lefts, rights = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    unit = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero(small)
    for step in range(1, SMALL):
        at = at[at + step < len(fps)]
        at = at[unit[at + step] == unit[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        lefts.append(fps[near])
        rights.append(fps[near + step])
    for k in np.flatnonzero(sizes > SMALL).tolist():
        own = np.unique(fps[bounds[k] : bounds[k + 1]])
        label = forest(len(own), lambda i, own=own: i + 1 + np.flatnonzero(np.bitwise_count(own[i + 1 :] ^ own[i]) <= radius))
        moved = np.flatnonzero(label != np.arange(len(own)))
        lefts.append(own[moved])
        rights.append(own[label[moved]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def _nodes(
    docs: DataFrame, radius: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprint, and every fingerprint with its least id and the root of its component."""
    rows = cut_lineage(fingerprints(docs, doc_id, text, shingle, keep=keep))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min(doc_id).alias("least")))
    rooted = components(links(distinct.select("fp"), radius)).select(F.col("node").alias("fp"), "root")
    # Only linked fingerprints have a root; all others are their own component.
    return rows, distinct.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint and component_id.

    ``fingerprint`` is the SimHash of the whole text in 16 hex digits;
    fingerprints that differ in at most ``radius`` bits are linked, and
    ``component_id`` is the smallest doc_id reachable by links, itself
    included.  Equal fingerprints are one node, so copies cost nothing beyond
    their row.  A null text counts as empty, texts without words have
    fingerprint zero and are linked like any others.  Rows with a null id get
    the smallest id of their component, null if it has none.  Repeated rows are
    kept; other columns of ``docs`` are ignored.
    """
    rows, known = _nodes(docs, radius, shingle, doc_id, text)
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    least = least.select(dealt_anew(least, "root").alias("root"), "component_id")
    named = known.select("fp", "root").join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, F.col("fp") == F.col("_fp"), "left").select(doc_id, digits.alias("fingerprint"), "component_id")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed, which names a row beside its id; maps and variants cannot."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if _hashable(f.dataType)]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def least_rows(rows: DataFrame, group: str, doc_id: str) -> DataFrame:
    """The row (doc_id, row) with the smallest id, then the smallest hash, of every group that has an id."""
    named = rows.where(F.col(doc_id).isNotNull())
    first = named.groupBy(group).agg(F.min(F.struct(F.col(doc_id), F.col("row"))).alias("_first"))
    return first.select(group, F.col("_first")[doc_id].alias(doc_id), F.col("_first")["row"].alias("row"))


def first_rows(docs: DataFrame, marked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each ``root`` of ``marked`` (doc_id, row, root): the smallest id, then the smallest hash.

    Rows are chosen, not ids: an id that occurs with texts of two groups may be
    chosen for both.  Of equal rows one is kept.  A row without an id cannot be
    named as a duplicate and stays.
    """
    row, kept_id, kept_row = (fresh(n, docs) for n in ("_row_hash", "_kept_id", "_kept_row"))
    chosen = least_rows(marked, "root", doc_id).select(F.col(doc_id).alias(kept_id), F.col("row").alias(kept_row))
    hashed = docs.withColumn(row, row_hash(docs))
    same = (F.col(doc_id) == F.col(kept_id)) & (F.col(row) == F.col(kept_row))
    # The semi join has dealt the rows by id and hash, so dropping equal rows needs no further shuffle.
    first = hashed.join(chosen, same, "left_semi").dropDuplicates([doc_id, row]).drop(row)
    return first.unionByName(docs.where(F.col(doc_id).isNull()))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component: the one with its smallest id; see ``first_rows``.

    All columns of ``docs`` come back as they were, whatever their names and types.
    """
    row = fresh("_row_hash", docs)
    hashed = docs.select(doc_id, text, row_hash(docs).alias(row))
    rows, known = _nodes(hashed, doc_id=doc_id, text=text, keep=(row,), **options)
    firsts = least_rows(rows.select(doc_id, F.col(row).alias("row"), "fp"), "fp", doc_id)
    return first_rows(docs, firsts.join(known.select("fp", "root"), "fp"), doc_id)
