"""Keep-last on an unbounded table: keyed state, event-time timers and expiry."""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Fixed value: keyed state with timers needs this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _millis(moment: dt.datetime) -> int:
    """Milliseconds since 1970, rounded up; a time without a zone is in UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    past = moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return -(-past // dt.timedelta(milliseconds=1))


def _last_of_batch(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key of every Arrow batch, so that a hot key sends few rows to its state."""
    by = [(key, "ascending"), *((o, "ascending") for o in order)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows < 2:
                yield batch
                continue
            at = pc.sort_indices(batch, sort_keys=by, null_placement="at_start")
            keys = batch.column(key).take(at).dictionary_encode(null_encoding="encode").indices
            last = pc.not_equal(keys.slice(0, len(keys) - 1), keys.slice(1))
            yield batch.take(at.filter(pa.concat_arrays([last, pa.array([True])])))

    return df.mapInArrow(run, df.schema)


class _KeepLast(StatefulProcessor):
    """State of a key: its last row and the time at which that is final."""

    def __init__(self, columns: Sequence[str], time: str, ties: Sequence[str], hold_ms: int):
        self.columns, self.time, self.ties, self.hold_ms = columns, time, ties, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The row as it came in, whatever its types.
        self.last = handle.getValueState("last", "row binary, expires_ms long")

    def _order(self, row: Sequence) -> tuple:
        """Nulls come first."""
        values = (row[self.columns.index(c)] for c in (self.time, *self.ties))
        return tuple((v is not None, v) if v is not None else (False,) for v in values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.last.get()) if self.last.exists() else None
        best = None if held is None else pickle.loads(held[0])
        newest = best
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            if newest is None or self._order(values) > self._order(newest):
                newest = values
        if newest is not best:
            expires = _millis(newest[self.columns.index(self.time)]) + self.hold_ms
            if held is not None:
                self.handle.deleteTimer(held[1])
            self.handle.registerTimer(expires)
            self.last.update((pickle.dumps(newest), expires))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.last.exists():
            return
        row, expires = tuple(self.last.get())
        if expires <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
            yield Row(**dict(zip(self.columns, pickle.loads(row))))

    def close(self) -> None:
        pass


def use_state(spark: SparkSession) -> None:
    """Let streams of this session keep keyed state with timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def keep_last_stream(
    stream: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str] = (),
    lateness: str = "1 hour",
    hold: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """The last row of every key of a stream, each once it is final.

    Last is the greatest ``time``, then the greatest ``ties`` (a null before all
    values).  The watermark follows the greatest time by ``lateness``.  A key's
    row is final, and put out in append mode, when the watermark has passed its
    time by ``hold``; the key's state is then dropped, so that the state holds
    no more keys than rows came in during ``lateness`` and ``hold``.

    Rows in any order and any cut into batches give the same result as long as
    they are on time.  A row older than the watermark is late: Spark drops it
    and counts it in ``numRowsDroppedByWatermark``.  An on-time row of a key
    that has been put out begins it anew and is put out as well: a later
    version of the key.  Rows without a time are dropped; a null key is a key.
    A time without a zone is taken in the session's.

    Call ``use_state`` before the stream is started.  The state lies in the
    stream's checkpoint folder and survives lost executors.
    """
    if time in ties or key in (time, *ties):
        raise ValueError("key, time and ties are different columns")
    known = stream.where(f"`{time}` IS NOT NULL").withColumn(time, F.col(time).cast("timestamp"))
    # A hot key's rows are thinned before the watermark looks at them: the last one is late only if all are.
    few = _last_of_batch(known, key, (time, *ties)).withWatermark(time, lateness)
    columns = stream.columns
    hold_ms = -(-hold // dt.timedelta(milliseconds=1))
    processor = _KeepLast(columns, time, tuple(ties), hold_ms)
    result = T.StructType([T.StructField(f.name, f.dataType) for f in few.schema])
    final = few.groupBy(key).transformWithState(processor, result, "Append", "EventTime")
    return final.withColumn(time, F.col(time).cast(stream.schema[time].dataType))
