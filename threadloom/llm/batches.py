"""Arrow helpers for operators that work on text in Python tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ship


def pieces(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``most_bytes`` of text; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start, rows = 0, batch.num_rows
        while start < rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts as Python strings, null as the empty one."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def fresh(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case of its letters."""
    taken = {c.lower() for df in frames for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}{n}"
    return name


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession, most_bytes: int = 8 << 20) -> SparkSession:
    """Ship this library to the workers and bound the bytes of an Arrow batch for this session.

    Spark's own bound counts rows and 64 MB; whole texts are large, and the JVM
    and the worker each hold a batch per task.
    """
    spark.conf.set(BATCH_BYTES, str(most_bytes))
    return ship(spark)
