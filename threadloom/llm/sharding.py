"""Two-pass external shuffle into shards of equal row counts, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import work_path

_BUCKET, _ITEM, _ITEMS, _INDEX, _TIE = (f"_shuffle_{n}" for n in ("bucket", "item", "items", "index", "tie"))


def record_size(text: str = "text"):
    """UTF-8 bytes of the text plus eight for the id; a null text has none."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(8).cast("long")


def external_shuffle(
    df: DataFrame,
    size: str | Column,
    shards: int = 24,
    seed: int = 20_251,
    bucket_bytes: int = 64 << 20,
    least_buckets: int = 256,
    shard: str = "shard",
    slot: str = "slot",
) -> DataFrame:
    """All rows of ``df`` in random order, cut into ``shards`` runs that differ by one row at most.

    Pass 1 scatters whole rows by a seeded hash over buckets of about
    ``bucket_bytes`` of ``size`` (never fewer than ``least_buckets``, so that
    small inputs use many tasks as well).  The hash covers the row's place in
    the input beside its size, so repeated rows spread as evenly as different
    ones and no hot key exists.  Pass 2 draws a Fisher-Yates permutation of
    every bucket and writes it to the shared folder.  A row's global place is
    its bucket's offset plus its place in the bucket; shard ``s`` holds the
    places from ``ceil(s * n / shards)`` on, and ``slot`` counts from 0 without
    gaps.

    The drawn rows are read back from what was written once: offsets and rows
    come from the same draw whatever executor is lost.  Columns of ``df`` named
    like ``shard`` or ``slot`` are replaced.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c.lower() not in (shard.lower(), slot.lower())]
    weight = F.col(size) if isinstance(size, str) else size
    total = df.agg(F.sum(weight).alias("bytes")).first()["bytes"] or 0
    buckets = max(least_buckets, -(-int(total) // bucket_bytes))
    placed = F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), weight)
    item = F.struct(F.col(_TIE), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    scattered = (
        df.withColumn(_TIE, placed)
        .select(F.pmod(F.col(_TIE), F.lit(buckets)).cast("int").alias(_BUCKET), item.alias(_ITEM))
        .repartition(_BUCKET)
    )
    # One bucket at a time fits a task; the sort makes the draw independent of arrival order.
    by_tie = lambda a, b: F.when(a[_TIE] < b[_TIE], -1).when(a[_TIE] > b[_TIE], 1).otherwise(0)
    drawn = scattered.groupBy(_BUCKET).agg(
        F.shuffle(F.array_sort(F.collect_list(_ITEM), by_tie), F.lit(seed)).alias(_ITEMS)
    )
    path = work_path(spark, "shuffled")
    laid = drawn.select(_BUCKET, F.posexplode(_ITEMS).alias(_INDEX, _ITEM)).select(_BUCKET, _INDEX, F.col(f"{_ITEM}.row").alias(_ITEM))
    laid.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(laid.schema).parquet(path)
    # One row per bucket: the number of buckets is the input over the bucket size.
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(_BUCKET).agg(F.count("*").alias("_n"))
    offsets = counts.select(
        F.col(_BUCKET).alias("_offset_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("long")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_rows"),
    )
    return (
        stored.join(offsets, F.col(_BUCKET) == F.col("_offset_of"))
        .withColumn("_place", F.col("_offset") + F.col(_INDEX))
        .withColumn("_shard", F.expr(f"(_place * {shards}) div _rows"))
        .select(
            *[F.col(f"{_ITEM}.`{c}`").alias(c) for c in columns],
            F.col("_shard").cast("int").alias(shard),
            F.expr(f"_place - (_shard * _rows + {shards - 1}) div {shards}").alias(slot),
        )
    )


def write_shards(shuffled: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard.  A bucket lies in one or two shards, so the rows need no further shuffle.

    Each file holds its rows in slot order; many tasks write one large shard.
    """
    shuffled.sortWithinPartitions(shard, slot).write.partitionBy(shard).option("compression", "zstd").mode("error").parquet(path)


def shard_documents(docs: DataFrame, shards: int = 24, path: str | None = None, **options) -> DataFrame:
    """Where every document went: one row per row of ``docs``, under the law ``rows``.

    Whole documents are shuffled and written as shards below ``path`` (a fresh
    folder of the shared one unless given); what is returned is told from the
    shards.  That is doc_id, size, text_crc32 (of the UTF-8 text, that of the
    empty text for null), law, shard, slot and grown_shard (null under this law).
    Null ids, repeated rows and very long texts are rows like any other; other
    columns of ``docs`` go with their rows.
    """
    spark = docs.sparkSession
    path = path or work_path(spark, "shards")
    shuffled = external_shuffle(docs, record_size(), shards, **options)
    write_shards(shuffled, path)
    written = spark.read.schema(shuffled.schema).parquet(path)
    text = F.coalesce(F.col("text"), F.lit(""))
    return written.select(
        "doc_id",
        record_size().alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
