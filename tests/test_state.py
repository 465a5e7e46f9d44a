"""Stateful keep-last: any order, late rows, new versions, ties."""

import datetime as dt

import pytest

from threadloom.sources.files import write_files
from threadloom.streaming.state import keep_last_stream, use_state

SCHEMA = "id string, at timestamp, n int, note string"
DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


@pytest.fixture
def played(spark, tmp_path):
    """Rows of the output after playing the batches, with the rows dropped as late."""

    def play(batches, **options):
        use_state(spark)
        source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
        late = 0
        for rows in batches:
            write_files(spark.createDataFrame(rows, SCHEMA).coalesce(1), "parquet", source, mode="append")
            stream = spark.readStream.schema(SCHEMA).parquet(source)
            kept = keep_last_stream(stream, "id", "at", ["n"], **options)
            query = kept.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
            query.awaitTermination()
            late += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
        found = spark.read.schema(SCHEMA).parquet(out).collect()
        return sorted(((r.id, r.at, r.n, r.note) for r in found), key=repr), late

    return play


END = ("end", at(10_000), 0, None)


def test_order_and_ties(played):
    rows = [("a", at(5), 1, "x"), ("a", at(9), None, "null tie"), ("b", at(1), 1, "b"), (None, at(2), 1, "no id"), ("c", None, 1, "no time")]
    more = [("a", at(9), 2, "last"), ("a", at(9), 1, "y"), ("b", at(0), 9, "older"), (None, at(1), 5, "older")]
    got, late = played([rows, more, [END]], lateness="1 day")
    assert got == sorted([("a", at(9), 2, "last"), ("b", at(1), 1, "b"), (None, at(2), 1, "no id")], key=repr) and late == 0


def test_late_rows_are_dropped_and_new_versions_put_out(played):
    batches = [
        [("a", at(0), 1, "first"), ("b", at(100), 1, "moves the watermark to 90")],
        [("z", at(50), 1, "late"), ("a", at(95), 1, "on time"), ("b", at(200), 1, "to 190")],
        [END],
    ]
    got, late = played(batches, lateness="10 minutes")
    # What is final is put out once the watermark has passed it.
    assert [r for r in got if r[0] == "a"] == [("a", at(0), 1, "first"), ("a", at(95), 1, "on time")]
    assert ("b", at(200), 1, "to 190") in got and all(r[0] != "z" for r in got) and late == 1


def test_hold_keeps_a_key_open(played):
    batches = [
        [("a", at(0), 1, "first"), ("b", at(100), 1, "to 90")],
        [("a", at(95), 1, "second"), ("b", at(200), 1, "to 190")],
        [END],
    ]
    got, _ = played(batches, lateness="10 minutes", hold=dt.timedelta(hours=2))
    assert got == [("a", at(95), 1, "second"), ("b", at(200), 1, "to 190")]


def test_columns_must_differ(spark):
    with pytest.raises(ValueError):
        keep_last_stream(spark.readStream.format("rate").load(), "value", "timestamp", ["value"])
