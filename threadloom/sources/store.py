"""A store of posts and comments with atomic keyed upserts.

Every save writes one new folder below ``<root>/<table>`` and leaves the others
alone.  ``full-<number>`` holds the whole table, ``part-<number>`` only the rows a
batch changed or added, complete with all columns, and ``sum-<number>`` all rows
changed since the full folder.  Spark's ``_SUCCESS`` marker commits a folder, so
a failed or interrupted save leaves the previous state visible, and a reader is
never disturbed by a writer.  The current table is the newest full folder with
the later ones laid over it by key; saving a small batch into a large table
therefore writes the batch, not the table.  A table has one writer at a time.

The way a batch is merged depends on the format: tables merge by column, JSON
replaces whole rows, CSV appends and keeps the last row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.dedup import _hashable, keep_last
from ..operators.filters import by_equality
from ..operators.relate import known
from ..operators.upsert import Order, latest_rows, merge_columns, replace_rows
from ..schemas import TABLES, relaxed, required
from ..session import cut_lineage, size_shuffles
from .files import file_format, read_files, write_files
from .search_index import SearchIndex


def reject_reasons(df: DataFrame, columns: Sequence[str]) -> Column:
    """Names of the required columns that are null, as an array."""
    checks = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return F.array_compact(checks)


def split_valid(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that have every required value, and the others with their reasons."""
    absent = [c for c in required(schema) if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast(schema[c].dataType) for c in absent})
    marked = df.withColumn("reject_reasons", reject_reasons(df, required(schema)))
    bad = F.size("reject_reasons") > 0
    return marked.where(~bad).drop("reject_reasons"), marked.where(bad)


def enforce_required(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Fail the running job when a row lacks a required value.

    The check sits in the key column, so no projection can prune it away and it
    costs no extra pass.
    """
    if not columns:
        return df
    broken = reduce(or_, [F.col(c).isNull() for c in columns])
    message = F.concat(
        F.lit("required values missing: "),
        F.concat_ws(",", reject_reasons(df, columns)),
    )
    kind = df.schema[key].dataType
    return df.withColumn(
        key, F.when(broken, F.raise_error(message).cast(kind)).otherwise(F.col(key))
    )


class Store:
    """Posts and comments below one root folder, in one format.

    ``schemas`` maps table names to schemas and may replace the default pair.
    Field nullability is the NOT NULL constraint of a table format; JSON and
    CSV stores hold whatever they are given.

    After ``max_parts`` parts the next save gathers them into one sum, or, when
    they have grown beyond a quarter of the full folder, writes the whole table
    again.  With ``max_parts=0`` every save writes the whole table.

    ``search`` names the text columns of tables that are to be searched: their
    postings are brought up to date by every save (see ``search_index``).
    """

    def __init__(
        self,
        spark: SparkSession,
        fmt: str,
        root: str,
        key: str = "id",
        schemas: Mapping[str, T.StructType] | None = None,
        max_parts: int = 8,
        search: Mapping[str, Sequence[str]] | None = None,
    ):
        self.spark = spark
        self.fmt = fmt.lower()
        self.kind = file_format(fmt)
        self.root = root.rstrip("/")
        self.key = key
        self.schemas = dict(schemas or TABLES)
        self.max_parts = max_parts
        self.search_fields = dict(search or {})

    # Folders -----------------------------------------------------------------

    def _path(self, *parts: str):
        """A Hadoop path below the root and the file system it lives in."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _folders(self, table: str, committed: bool = True) -> dict[int, str]:
        """Folder names on disk by number."""
        fs, top = self._path(table)
        names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
        return {
            int(name.partition("-")[2]): name
            for name in names
            if name.startswith(("full-", "sum-", "part-"))
            and (not committed or fs.exists(self._path(table, name, "_SUCCESS")[1]))
        }

    def _bytes(self, table: str, names: Sequence[str]) -> int:
        found = (self._path(table, name) for name in names)
        return sum(fs.getContentSummary(path).getLength() for fs, path in found)

    def version(self, table: str) -> int | None:
        """The number of the newest committed folder, None when nothing was ever saved."""
        return max(self._folders(table), default=None)

    def _layers(self, table: str, version: int | None) -> list[str]:
        """Folders that make up a version, oldest first: full, then sum, then parts."""
        done = [n for n in sorted(self._folders(table).items()) if version is None or n[0] <= version]
        layers: list[str] = []
        for _, name in done:
            if name.startswith("full-"):
                layers = [name]
            elif layers:
                layers = [layers[0], name] if name.startswith("sum-") else [*layers, name]
        return layers

    def forget(self, table: str) -> None:
        """Delete the folders that the current version does not need."""
        needed = self._layers(table, None)
        newest = self.version(table) or 0
        for number, name in self._folders(table, committed=False).items():
            # A failed save leaves an uncommitted folder; one above the newest version may be in the making.
            if name not in needed and number < newest:
                fs, path = self._path(table, name)
                fs.delete(path, True)

    # Reading -----------------------------------------------------------------

    def read(
        self,
        table: str,
        filters: Mapping[str, Any] | None = None,
        on_unknown: str = "raise",
        version: int | None = None,
    ) -> DataFrame:
        """The rows that equal every given filter; a table never saved is empty."""
        layers = self._layers(table, version)
        return by_equality(self._rows(table, layers), filters, on_unknown)

    def _rows(self, table: str, layers: Sequence[str]) -> DataFrame:
        schema = relaxed(self.schemas[table])
        if not layers:
            return self.spark.createDataFrame([], schema)

        base = self._layer(table, layers[0])
        if len(layers) == 1:
            return base
        return replace_rows(base, self._newest(table, layers[1:]), self.key, order_by=None)

    def _layer(self, table: str, name: str) -> DataFrame:
        schema = relaxed(self.schemas[table])
        return read_files(self.spark, self.kind, f"{self.root}/{table}/{name}", schema)

    def _newest(self, table: str, names: Sequence[str], *more: DataFrame) -> DataFrame:
        """The rows of several layers, the later layer winning per key."""
        layers = [*(self._layer(table, n) for n in names), *more]
        if len(layers) == 1:
            return layers[0]
        numbered = [df.withColumn("_layer", F.lit(i)) for i, df in enumerate(layers)]
        together = reduce(DataFrame.unionByName, numbered)
        return keep_last(together, self.key, ["_layer"], unique_order=True).drop("_layer")

    def posts(self, filters: Mapping[str, Any] | None = None, **options) -> DataFrame:
        return self.read("posts", filters, **options)

    def comments(self, filters: Mapping[str, Any] | None = None, **options) -> DataFrame:
        return self.read("comments", filters, **options)

    # Writing -----------------------------------------------------------------

    def changes(
        self,
        table: str,
        batch: DataFrame,
        order_by: Order = (),
        unique_order: bool = False,
        keep_newer: bool = False,
    ) -> DataFrame:
        """The rows a batch changes or adds, as they will be stored.

        With ``keep_newer`` a stored row stays if its ``order_by`` values are
        greater than the batch's, so late rows do not undo newer ones.
        """
        schema = self.schemas[table]
        unknown = [c for c in batch.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"columns not in {table}: {', '.join(unknown)}")
        typed = batch.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in batch.columns])
        latest = latest_rows(typed, self.key, order_by, unique_order)
        absent = [n for n in schema.names if n not in latest.columns]
        layers = self._layers(table, None)
        if keep_newer and layers and order_by:
            latest = self._not_older(table, layers, latest, order_by)
        if self.kind == "parquet" and absent and layers:
            # Only the columns a batch lacks have to be fetched from the table.
            stored = self._rows(table, layers).select(self.key, *absent)
            rows = merge_columns(known(stored, latest, self.key), latest, self.key, None)
        else:
            rows = latest.withColumns({n: F.lit(None).cast(schema[n].dataType) for n in absent})
        if self.kind == "parquet":
            rows = enforce_required(rows, required(schema), self.key)
        return rows.select(*schema.names)

    def _not_older(self, table: str, layers: Sequence[str], latest: DataFrame, order_by: Sequence) -> DataFrame:
        """The batch's rows without those older than the row that is stored for their key."""
        order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by])
        stored = self._rows(table, layers).select(F.col(self.key).alias("_stored"), order.alias("_stored_order"))
        marked = latest.withColumn("_order", order)
        found = marked.join(known(stored, latest.select(F.col(self.key).alias("_stored")), "_stored"),
                            F.col(self.key) == F.col("_stored"), "left")
        older = F.col("_stored_order").isNotNull() & (F.col("_order") < F.col("_stored_order"))
        return found.where(~older).select(*latest.columns)

    def save(
        self,
        table: str,
        batch: DataFrame,
        order_by: Order = (),
        unique_order: bool = False,
        keep_newer: bool = False,
    ) -> int:
        """Upsert a batch and return the number of the folder written.

        ``order_by`` tells which of several rows with one key is the last; None
        says that there are none.  If any row breaks a constraint, the whole
        batch fails and nothing changes.
        """
        layers = self._layers(table, None)
        size_shuffles(batch, stored_bytes=self._bytes(table, layers))
        rows = batch_rows = self.changes(table, batch, order_by, unique_order, keep_newer)
        later = layers[1:]
        if not layers:
            kind = "full"
        elif self.max_parts and len(later) < self.max_parts:
            kind = "part"
        elif self.max_parts and 4 * self._bytes(table, later) < self._bytes(table, layers[:1]):
            kind = "sum"
            rows = self._newest(table, later, rows)
        else:
            kind = "full"
            rows = replace_rows(self._rows(table, layers), rows, self.key, order_by=None)
        number = max(self._folders(table, committed=False), default=0) + 1
        path = f"{self.root}/{table}/{kind}-{number:08d}"
        if table not in self.search_fields:
            write_files(rows, self.kind, path)
            return number
        if kind == "sum":  # the rows written are more than the batch's
            batch_rows = cut_lineage(batch_rows)
            rows = self._newest(table, later, batch_rows)
        write_files(rows, self.kind, path)
        written = self._layer(table, f"{kind}-{number:08d}")
        self.index(table).update(batch_rows if kind == "sum" else written, number, whole=kind == "full")
        return number

    def index(self, table: str) -> SearchIndex:
        """The postings of a table that was named for search."""
        return SearchIndex(self.spark, f"{self.root}/{table}-postings", self.key, self.search_fields[table])

    def search(self, table: str, query: str, limit: int | None = 100, **options) -> DataFrame:
        """The rows of a table that match a query, from its stored postings.

        Should a save have ended between the table and its postings, the whole table is indexed again first.
        """
        index = self.index(table)
        if index.version != self.version(table):
            index.update(self.read(table), self.version(table), whole=True)
        return index.search(self.read(table), query, limit, **options)

    def save_posts(self, batch: DataFrame, **options) -> int:
        return self.save("posts", batch, **options)

    def save_comments(self, batch: DataFrame, **options) -> int:
        return self.save("comments", batch, **options)


def create_store(spark: SparkSession, fmt: str, root: str, **options) -> Store:
    """A store by format name (any case); an unknown name is a ``ValueError``."""
    return Store(spark, fmt, root, **options)


def reconcile(expected: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """One row comparing two tables by key: row counts, missing and surplus keys."""
    sides = expected.select(F.col(key), F.lit(1).alias("e"), F.lit(0).alias("s")).unionByName(
        stored.select(F.col(key), F.lit(0).alias("e"), F.lit(1).alias("s"))
    )
    keys = sides.groupBy(key).agg(F.sum("e").alias("e"), F.sum("s").alias("s"))
    return keys.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("rows_expected"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("rows_stored"),
        F.count(F.when(F.col("s") == 0, True)).alias("keys_missing"),
        F.count(F.when(F.col("e") == 0, True)).alias("keys_surplus"),
    )


def reconcile_rows(expected: DataFrame, stored: DataFrame, key: str = "id", bits: int = 16) -> DataFrame:
    """``(key, state)`` of every key whose rows differ: ``changed``, ``missing`` or ``surplus``.

    Compared are the columns of ``expected``, which ``stored`` has as well;
    repeated rows count.  A first pass reduces both tables to digests that do
    not depend on the order of rows, one for each of ``2 ** bits`` buckets of
    keys, and these to one for each of 256 groups of buckets.  Groups that agree
    are left; only the digests of the others come to the driver, and only rows
    of buckets that differ are compared, by a second digest for each key.  Equal
    tables therefore move digests only.  Null keys are one key.  Maps cannot be
    compared and raise an error.
    """
    columns = expected.columns
    if odd := [f.name for f in expected.schema if not _hashable(f.dataType)]:
        raise ValueError(f"columns that cannot be compared: {', '.join(odd)}")
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(1 << bits)).cast("int")
    names = [F.col(f"`{c}`") for c in columns]
    sides = []
    for sign, df in ((1, expected), (-1, stored)):
        # Nulls do not enter a hash, so it says which columns have one.
        nulls = F.array(*[n.isNull() for n in names])
        digest = [F.xxhash64(F.lit(seed), nulls, *names).cast("decimal(38,0)") * sign for seed in (1, 2)]
        sides.append(df.select(F.col(key).alias("key"), bucket.alias("bucket"), F.lit(sign).alias("rows"), *[d.alias(f"d{i}") for i, d in enumerate(digest)]))
    both = sides[0].unionByName(sides[1])
    left = [F.sum(c).alias(c) for c in ("rows", "d0", "d1")]
    differs = "rows <> 0 OR d0 <> 0 OR d1 <> 0"
    buckets = cut_lineage(both.groupBy("bucket").agg(*left))
    groups = [r["g"] for r in buckets.groupBy((F.col("bucket") % 256).alias("g")).agg(*left).where(differs).collect()]
    kind = expected.schema[key].dataType
    if not groups:
        return expected.sparkSession.createDataFrame([], T.StructType([T.StructField(key, kind), T.StructField("state", T.StringType())]))
    unequal = [r["bucket"] for r in buckets.where((F.col("bucket") % 256).isin(groups)).where(differs).select("bucket").collect()]
    present = [F.max(F.col("rows") > 0).alias("expected"), F.max(F.col("rows") < 0).alias("stored")]
    keys = both.where(F.col("bucket").isin(unequal)).groupBy("key").agg(*present, *[x.alias(n) for x, n in zip(left, ("r", "x", "y"))])
    state = F.when(~F.col("stored"), "missing").when(~F.col("expected"), "surplus").otherwise("changed")
    return keys.where("r <> 0 OR x <> 0 OR y <> 0").select(F.col("key").alias(key), state.alias("state"))
