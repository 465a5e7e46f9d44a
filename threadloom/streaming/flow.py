"""Structured Streaming: row-wise cleaning and micro-batch upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import TextOptions
from ..operators.filters import Moment
from ..plans.clean import clean_rows
from ..sources.store import Store


def clean_stream(
    stream: DataFrame,
    text_fields: Sequence[str],
    min_score: float | None = None,
    start_date: Moment | None = None,
    end_date: Moment | None = None,
    options: TextOptions | None = None,
    **columns,
) -> DataFrame:
    """The row-wise part of cleaning on an unbounded table.

    Keep-last deduplication is not row-wise: the last copy of a row is only
    known per batch, so it belongs to the upsert sink.
    """
    return clean_rows(
        stream,
        text_fields,
        remove_duplicates=False,
        min_score=min_score,
        start_date=start_date,
        end_date=end_date,
        options=options,
        **columns,
    )


def upsert_stream(
    stream: DataFrame,
    store: Store,
    table: str,
    checkpoint: str,
    order_by: Sequence[str | Column] = (),
    unique_order: bool = False,
    available_now: bool = False,
    interval: str = "1 minute",
    keep_newer: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch into a store table.

    Spark may deliver the last batch again after a failure.  Saving is a keyed
    upsert into a new snapshot, so applying a batch twice gives the same rows.
    Without ``keep_newer`` a later batch replaces an earlier one; with it, the
    row greatest in ``order_by`` stays however the rows are cut into batches.
    ``checkpoint`` must be in a folder shared by the cluster.
    """

    def save(batch: DataFrame, _batch_id: int) -> None:
        store.save(table, batch, order_by=order_by, unique_order=unique_order, keep_newer=keep_newer)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
