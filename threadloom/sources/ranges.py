"""Records of JSON arrays and CSV files that are read by byte ranges, many tasks to a file.

Such files cannot be cut at any line break or bracket: it may lie inside a text.
Spark's text reader cuts them at a separator (``}`` or a line break) all the same,
and a first pass finds for each byte range what it does to the reader's state, for
both states that may hold where it begins: inside or outside quotes, and how deep
inside brackets.  Composed over the ranges of a file, these transitions give the
state at which every range begins; a second pass cuts each range into records.
Records that cross a border come out in pieces and are put together by the order
of the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import bound_batches, cut_lineage

#: States of this many ranges (some 100 bytes each) are sent to all tasks; more are joined.
_SENT = 100_000

_QUOTE, _ESCAPE, _OPEN, _CLOSE = 1, 2, 3, 4


def _kinds(marks: dict[str, int]) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for mark, kind in marks.items():
        table[ord(mark)] = kind
    return table


@dataclass(frozen=True)
class Shape:
    """How records of a kind of file end.

    ``separator`` cuts the file into fragments.  A record ends at a separator outside
    quotes; for nested files also only at depth ``level``, the separator itself
    closing one more bracket.  ``level`` is None for files without depth.
    """

    separator: str
    kinds: np.ndarray
    level: int | None


JSON_ARRAY = Shape("}", _kinds({'"': _QUOTE, "\\": _ESCAPE, "{": _OPEN, "[": _OPEN, "]": _CLOSE}), 2)
CSV = Shape("\n", _kinds({'"': _QUOTE}), None)


def _fragments(column: pa.Array, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per fragment: its quotes, and its change of depth if it begins outside or inside quotes."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = shape.kinds[raw]
    place = np.flatnonzero(kind)
    kind = kind[place]
    escapes = place[kind == _ESCAPE]
    if len(escapes):
        # A quote behind an odd run of escapes is text.
        first = np.append(True, np.diff(escapes) > 1)
        length = np.diff(np.append(np.flatnonzero(first), len(escapes)))
        odd = escapes[np.append(np.flatnonzero(first)[1:], len(escapes)) - 1][length % 2 == 1]
        real = (kind != _ESCAPE) & ~((kind == _QUOTE) & np.isin(place - 1, odd))
        place, kind = place[real], kind[real]
    quote = kind == _QUOTE
    before = np.append(0, np.cumsum(quote))  # quotes before each mark
    cut = np.searchsorted(place, ends)
    quotes = np.diff(before[cut])
    step = np.where(kind == _OPEN, 1, np.where(kind == _CLOSE, -1, 0))
    outside = np.append(0, np.cumsum(np.where(before[:-1] % 2 == 0, step, 0)))
    inside = np.append(0, np.cumsum(np.where(before[:-1] % 2 == 1, step, 0)))
    changes = np.diff(outside[cut]), np.diff(inside[cut])
    flipped = before[cut[:-1]] % 2 == 1
    return quotes, np.where(flipped, changes[1], changes[0]), np.where(flipped, changes[0], changes[1])


def _walk(quotes: np.ndarray, out: np.ndarray, in_: np.ndarray, shape: Shape, inside: int, depth: int):
    """State behind every fragment: inside quotes, depth before its separator, depth behind it."""
    after = (inside + np.cumsum(quotes)) % 2
    start = np.append(inside, after[:-1])
    change = np.where(start == 0, out, in_)
    closing = (after == 0).astype(np.int64) if shape.level is not None else np.zeros(len(after), np.int64)
    behind = depth + np.cumsum(change - closing)
    return after, behind + closing, behind


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of each byte range of a batch."""
    path, start = batch.column("path").dictionary_encode(), batch.column("start").to_numpy()
    code = path.indices.to_numpy()
    new = np.append(0, np.flatnonzero((start[1:] != start[:-1]) | (code[1:] != code[:-1])) + 1)
    for a, b in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows]):
        yield path.dictionary[int(code[a])].as_py(), int(start[a]), batch.slice(a, b - a)


def read_fragments(spark: SparkSession, paths: str | list[str], shape: Shape) -> DataFrame:
    """(path, start, value): the fragments of every byte range, in their order within a task.

    All passes must see the same ranges, while Spark cuts files by settings and
    the cores it has at the time.  The reader belongs to a session of its own
    that holds both as they are now.
    """
    fixed = bound_batches(bound_batches(spark).newSession())
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        fixed.conf.set(name, spark.conf.get(name))
    cores = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    fixed.conf.set("spark.sql.files.minPartitionNum", str(cores))
    read = fixed.read.text(paths, lineSep=shape.separator)
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")]
    none = spark.sql("SELECT '' AS path, 0L AS start, '' AS value WHERE false")  # its session runs the plan
    return none.unionByName(read.select(*place, "value"))


def range_states(fragments: DataFrame, shape: Shape) -> DataFrame:
    """(path, start, inside, depth, first, end_inside, end_depth) of every byte range.

    ``first`` is the first record of a file that begins with the range and ends in it.
    """
    schema = "path string, start long, p0 int, d0 long, p1 int, d1 long, first string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # path, start, [(inside, depth)] for both beginnings, pieces of the first record, whether it has ended

        def made() -> pa.RecordBatch:
            path, start, states, first, ended = held
            (p0, d0), (p1, d1) = states
            row = [path, start, p0, d0, p1, d1, shape.separator.join(first) if ended else None]
            types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            names = ["path", "start", "p0", "d0", "p1", "d1", "first"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            for path, start, rows in _runs(batch):
                if held and (held[0], held[1]) != (path, start):
                    yield made()
                    held = []
                if not held:
                    held = [path, start, [(0, 0), (1, 0)], [], start > 0]
                marks = _fragments(rows.column("value"), shape)
                states = []
                for n, (inside, depth) in enumerate(held[2]):
                    after, _, behind = _walk(*marks, shape, inside, depth)
                    states.append((int(after[-1]), int(behind[-1])))
                    if n == 0 and not held[4] and shape.level is None:
                        stop = np.flatnonzero(after == 0)
                        upto = int(stop[0]) + 1 if len(stop) else rows.num_rows
                        held[3] += rows.column("value").slice(0, upto).to_pylist()
                        held[4] = len(stop) > 0
                held[2] = states
        if held:
            yield made()

    each = cut_lineage(fragments.mapInArrow(run, schema))
    order = Window.partitionBy("path").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    # Parity of quotes adds up whatever the state; with it, each range's change of depth is known and adds up as well.
    inside = F.coalesce(F.sum("p0").over(earlier), F.lit(0)) % 2
    known = each.withColumn("inside", inside.cast("int"))
    change = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    known = known.withColumn("change", change).withColumn("depth", F.coalesce(F.sum("change").over(earlier), F.lit(0).cast("long")))
    return cut_lineage(
        known.select(
            "path",
            "start",
            "inside",
            "depth",
            F.when(F.col("start") == 0, F.col("first")).alias("first"),
            F.when(F.col("inside") == 0, F.col("p0")).otherwise(F.col("p1")).alias("end_inside"),
            (F.col("depth") + F.col("change")).alias("end_depth"),
        )
    )


def check_ends(states: DataFrame, shape: Shape) -> None:
    """Fail for files that end inside a record."""
    last = states.groupBy("path").agg(F.max_by(F.struct("end_inside", "end_depth"), "start").alias("end"))
    # The text behind the last bracket of an array counts as one more fragment, whose separator is not there.
    whole = (F.col("end.end_inside") == 0) & (F.col("end.end_depth") == (0 if shape.level is None else -1))
    if broken := last.where(~whole).select("path").take(1):
        raise ValueError(f"{broken[0]['path']} does not end where a record ends")


_WHOLE, _END, _OPEN_END = 0, 1, 2


def _begins(start: Column, seq: Column) -> Column:
    return ((start == 0) & (seq == 0)).alias("first")


def records(fragments: DataFrame, states: DataFrame, shape: Shape, tidy: Callable[[str], str | None]) -> DataFrame:
    """(path, first, text): every record once, ``tidy`` having removed what stands around it (None: no record).

    ``first`` marks the record with which a file begins.
    """
    spark = fragments.sparkSession
    known = states.select("path", "start", "inside", "depth")
    if states.count() <= _SENT:
        joined = fragments.join(F.broadcast(known), ["path", "start"], "left")  # keeps the order of the fragments
    else:
        placed = fragments.withColumn("at", F.monotonically_increasing_id())
        joined = placed.join(known, ["path", "start"], "left").sortWithinPartitions("path", "start", "at")
    joined = joined.select("path", "start", "value", "inside", "depth")
    schema = "path string, start long, seq long, role int, text string"
    glue = shape.separator

    def at_border(inside: int, depth: int) -> bool:
        return inside == 0 and (shape.level is None or depth < shape.level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        inside = depth = seq = 0
        open_: list[str] = []  # fragments since the last border
        whole = True  # whether they begin at a border

        def rest(out: list) -> None:
            if open_ and not (shape.level is not None and inside == 0 and depth < 0):
                out.append((*at, seq, _OPEN_END, glue.join(open_) + glue))
            elif open_:  # behind the last bracket of an array
                tidy(open_[0])

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            for path, start, rows in _runs(batch):
                if at != (path, start):
                    rest(out)
                    at, seq, open_ = (path, start), 0, []
                    inside, depth = rows.column("inside")[0].as_py(), rows.column("depth")[0].as_py()
                    if inside is None:
                        raise ValueError(f"{path} is no longer cut at byte {start}; read it again")
                    whole = at_border(inside, depth)
                after, before_, behind = _walk(*_fragments(rows.column("value"), shape), shape, inside, depth)
                border = after == 0 if shape.level is None else (after == 0) & (before_ == shape.level)
                values = rows.column("value").to_pylist()
                done = 0
                for k in np.flatnonzero(border).tolist():
                    text = glue.join([*open_, *values[done : k + 1]]) + (glue if shape.level is not None else "")
                    if not whole:
                        out.append((path, start, seq, _END, text))
                    elif (record := tidy(text)) is not None:
                        out.append((path, start, seq, _WHOLE, record))
                    open_, done, whole, seq = [], k + 1, True, seq + 1
                open_ += values[done:]
                inside, depth = int(after[-1]), int(behind[-1])
            yield _rows(out)
        out = []
        if at is not None:
            rest(out)
        yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "start", "seq", "role", "text"])

    made = joined.mapInArrow(run, schema)
    # At most two pieces of each range: which belong together is told without their texts.
    pieces = cut_lineage(made.where(F.col("role") != _WHOLE))
    earlier = Window.partitionBy("path").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    named = pieces.select("path", "start", "seq", F.coalesce(F.sum((F.col("role") == _END).cast("long")).over(earlier), F.lit(0)).alias("record"))
    stitched = (
        pieces.join(named, ["path", "start", "seq"])
        .groupBy("path", "record")
        .agg(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("parts"))
        .select("path", _begins(F.col("parts")[0]["start"], F.col("parts")[0]["seq"]), F.array_join(F.col("parts.text"), "").alias("text"))
    )

    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [tidy(t) for t in batch.column("text").to_pylist()]
            keep = [i for i, t in enumerate(texts) if t is not None]
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column("path"), kept.column("first"), pa.array([texts[i] for i in keep], pa.string())], names=["path", "first", "text"]
            )

    crossing = stitched.mapInArrow(tidied, "path string, first boolean, text string")
    inner = made.where(F.col("role") == _WHOLE).select("path", _begins(F.col("start"), F.col("seq")), "text")
    return inner.unionByName(crossing)


def json_record(text: str) -> str | None:
    """The object in a piece of an array, without the comma or bracket before it; the end of the array is no record."""
    record = text.lstrip("﻿")
    record = record.lstrip(" \t\r\n")
    if record[:1] in ("[", ","):
        record = record[1:].lstrip(" \t\r\n")
    if record[:1] == "{":
        return record
    if record.strip(" \t\r\n") in ("", "]"):
        return None
    raise ValueError(f"no JSON object: {record[:40]!r}")


def csv_record(text: str) -> str | None:
    """A record without the line break behind it; empty lines are no records."""
    record = text.removesuffix("\n").removesuffix("\r")
    return record or None
