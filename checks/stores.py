"""Stores: round trips, upserts and reconciliation in every format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F, types as T

from threadloom.session import work_path
from threadloom.sources.files import import_csv, import_json_array
from threadloom.sources.store import Store, create_store, reconcile, reconcile_rows

from .merges import MERGED_SQL, REPLACED_SQL, order_batch
from .registry import check, load


def schema_of(df, *required):
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in df.schema])


for _fmt in ("table", "json", "csv"):

    @check(f"store_roundtrip_{_fmt}", "SELECT * FROM documents")
    def roundtrip(spark, folder, fmt=_fmt):
        docs = load(spark, folder, "documents")
        schemas = {"documents": schema_of(docs, "doc_id", "text")}
        store = Store(spark, fmt, work_path(spark, f"store-{fmt}"), "doc_id", schemas)
        store.save("documents", docs, order_by=None)
        return store.read("documents")

    @check(f"store_upsert_{_fmt}", MERGED_SQL if _fmt == "table" else REPLACED_SQL)
    def upsert(spark, folder, fmt=_fmt):
        orders = load(spark, folder, "orders")
        schemas = {"orders": schema_of(orders, "o_orderkey")}
        store = Store(spark, fmt, work_path(spark, f"upsert-{fmt}"), "o_orderkey", schemas)
        store.save("orders", orders, order_by=None)
        store.save("orders", order_batch(orders))
        return store.read("orders")


@check("store_filter", "SELECT doc_id, text FROM documents WHERE lang = 'fr' AND source = 'src0'")
def filtered_read(spark, folder):
    docs = load(spark, folder, "documents")
    store = Store(spark, "table", work_path(spark, "store-filter"), "doc_id", {"documents": schema_of(docs)})
    store.save("documents", docs, order_by=None)
    return store.read("documents", {"lang": "fr", "source": "src0"}).select("doc_id", "text")


@check(
    "store_reconcile",
    """SELECT (SELECT count(*) FROM documents) AS rows_expected, (SELECT count(*) FROM labels) AS rows_stored,
       (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS keys_missing,
       (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS keys_surplus""",
)
def compared(spark, folder):
    return reconcile(load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id")


# A stored copy in which some rows have changed, some are lost and some are more.
@check(
    "store_reconcile_rows",
    """SELECT doc_id, CASE doc_id % 50 WHEN 3 THEN 'changed' WHEN 5 THEN 'missing' END AS state FROM documents WHERE doc_id % 50 IN (3, 5)
       UNION ALL SELECT -1 - doc_id, 'surplus' FROM documents WHERE doc_id % 100 = 7""",
)
def reconciled_rows(spark, folder):
    docs = load(spark, folder, "documents")
    store = Store(spark, "table", work_path(spark, "reconciled"), "doc_id", {"documents": schema_of(docs)})
    fifty = F.col("doc_id") % 50
    text = F.when(fifty == 3, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text"))
    more = docs.where("doc_id % 100 = 7").withColumn("doc_id", -1 - F.col("doc_id"))
    store.save("documents", docs.where(fifty != 5).withColumn("text", text).unionByName(more), order_by=None)
    return reconcile_rows(docs, store.read("documents"), "doc_id")


# Times with microseconds and texts that look like a null mark survive every format.
for _fmt in ("table", "json", "csv"):

    @check(
        f"store_roundtrip_events_{_fmt}",
        r"""SELECT event_id, ts + to_microseconds(event_id % 1000000) AS ts, user_id, event_type, value,
            CASE event_id % 4 WHEN 0 THEN '\N' WHEN 1 THEN '\\N' WHEN 2 THEN '' END AS note FROM events""",
    )
    def events_roundtrip(spark, folder, fmt=_fmt):
        events = load(spark, folder, "events").selectExpr(
            "event_id", "ts + make_dt_interval(0, 0, 0, (event_id % 1000000) / 1000000.0) AS ts", "user_id", "event_type", "value",
            r"CASE event_id % 4 WHEN 0 THEN '\\N' WHEN 1 THEN '\\\\N' WHEN 2 THEN '' END AS note",
        )
        store = Store(spark, fmt, work_path(spark, f"events-{fmt}"), "event_id", {"events": schema_of(events, "event_id")})
        store.save("events", events, order_by=None)
        return store.read("events")


def write_arrays(docs, path, array_bytes=64 << 20, text="text"):
    """One JSON array per file, of about ``array_bytes`` of text; the number of files grows with the table.

    Rows are dealt by a hash of all their columns, so neither their ids nor their order make an array larger.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64
    total = docs.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    tie = F.xxhash64(*docs.columns)
    records = docs.select(F.pmod(tie, F.lit(max(16, -(-total // array_bytes)))).alias("slice"), tie.alias("tie"), F.to_json(F.struct(*docs.columns)).alias("record"))
    # Line by line, so that no task holds a whole array.
    order = Window.partitionBy("slice").orderBy("tie", "record")
    begin = F.when(F.row_number().over(order) == 1, "[").otherwise(",")
    end = F.when(F.lead("tie").over(order).isNull(), "]").otherwise("")
    records.select("slice", F.concat(begin, "record", end).alias("value")).write.partitionBy("slice").text(path)


@check("import_json_array", "SELECT doc_id, text, lang FROM documents")
def json_array(spark, folder):
    """Files that hold one JSON array each, as other tools write them."""
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    path = work_path(spark, "arrays")
    write_arrays(docs, path)
    return import_json_array(spark, path, docs.schema).select(*docs.columns)


@check("import_csv", "SELECT doc_id, nullif(text, '') AS text, lang FROM documents")
def foreign_csv(spark, folder):
    """CSV files whose columns come in two orders; an empty field is null, whatever it was before it was written."""
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    path = work_path(spark, "foreign")
    for part, names in ((0, ["doc_id", "text", "lang"]), (1, ["lang", "doc_id", "text"])):
        some = docs.where(F.col("doc_id") % 2 == part).select(*names)
        some.write.csv(path, header=True, escape='"', quoteAll=True, mode="append")
    return import_csv(spark, path, docs.schema)


@check(
    "store_empty",
    """SELECT doc_id, text, lang, source, n_chars, 'none yet' AS state FROM documents WHERE false
       UNION ALL SELECT *, 'saved' FROM documents""",
)
def empty_then_saved(spark, folder):
    """A table never saved reads as empty; the read after the first save has all rows."""
    docs = load(spark, folder, "documents")
    store = Store(spark, "table", work_path(spark, "store-empty"), "doc_id", {"documents": schema_of(docs)})
    before = store.read("documents").withColumn("state", F.lit("none yet"))
    store.save("documents", docs, order_by=None)
    return before.unionByName(store.read("documents").withColumn("state", F.lit("saved")))


@check(
    "create_store_names",
    """SELECT name, kind, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars
       FROM documents, (VALUES ('Table', 'parquet'), ('PARQUET', 'parquet'), ('sqlite', 'parquet'), ('JSON', 'json'), ('Csv', 'csv')) AS f(name, kind)
       GROUP BY ALL""",
)
def store_names(spark, folder):
    """Every name a store can be made by, in any case."""
    docs = load(spark, folder, "documents").select("doc_id", "n_chars")
    parts = []
    for name in ("Table", "PARQUET", "sqlite", "JSON", "Csv"):
        store = create_store(spark, name, work_path(spark, f"named-{name}"), key="doc_id", schemas={"documents": schema_of(docs)})
        store.save("documents", docs, order_by=None)
        parts.append(store.read("documents").select(F.lit(name).alias("name"), F.lit(store.kind).alias("kind"), "n_chars"))
    together = reduce(lambda a, b: a.unionByName(b), parts)
    return together.groupBy("name", "kind").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
