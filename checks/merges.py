"""Keep-last deduplication and keyed upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators.dedup import keep_last
from threadloom.operators.upsert import append_keep_last, merge_columns, replace_rows

from .registry import check, load


@check(
    "dedup_keep_last",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def dedup_keep_last(spark, folder):
    return keep_last(load(spark, folder, "events"), "user_id", ["ts", "event_id"], unique_order=True)


@check(
    "dedup_hot_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def dedup_hot_key(spark, folder):
    """Five keys share all rows; the shuffle moves at most one row per key and task."""
    return keep_last(load(spark, folder, "events"), "event_type", ["ts", "event_id"])


# The batch: orders of urgent priority with a changed price, status absent, plus the
# finished orders under new keys.
BATCH_SQL = """
batch AS (
  SELECT o_orderkey, o_custkey, o_totalprice + 10 AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_totalprice, 'new' FROM orders WHERE o_orderstatus = 'F')"""


def order_batch(orders):
    changed = orders.where("o_orderpriority = '1-URGENT'").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice + 10 AS o_totalprice", "CAST(NULL AS STRING) AS o_orderpriority"
    )
    added = orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey + 10000000 AS o_orderkey", "o_custkey", "o_totalprice", "'new' AS o_orderpriority"
    )
    return changed.unionByName(added)


MERGED_SQL = f"""WITH {BATCH_SQL}
    SELECT coalesce(b.o_orderkey, o.o_orderkey) AS o_orderkey,
      CASE WHEN b.o_orderkey IS NULL THEN o.o_custkey ELSE b.o_custkey END AS o_custkey,
      o.o_orderstatus,
      CASE WHEN b.o_orderkey IS NULL THEN o.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
      o.o_orderdate,
      CASE WHEN b.o_orderkey IS NULL THEN o.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority
    FROM orders o FULL OUTER JOIN batch b ON o.o_orderkey = b.o_orderkey"""

REPLACED_SQL = f"""WITH {BATCH_SQL}
    SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
    UNION ALL BY NAME SELECT * FROM batch"""


@check("upsert_merge_columns", MERGED_SQL)
def upsert_merge_columns(spark, folder):
    orders = load(spark, folder, "orders")
    return merge_columns(orders, order_batch(orders), "o_orderkey", strategy="full_outer")


@check("upsert_merge_columns_lookup", MERGED_SQL)
def upsert_merge_columns_lookup(spark, folder):
    orders = load(spark, folder, "orders")
    return merge_columns(orders, order_batch(orders), "o_orderkey", strategy="lookup")


@check("upsert_replace", REPLACED_SQL)
def upsert_replace(spark, folder):
    orders = load(spark, folder, "orders")
    return replace_rows(orders, order_batch(orders), "o_orderkey")


@check("upsert_append", REPLACED_SQL)
def upsert_append(spark, folder):
    orders = load(spark, folder, "orders")
    return append_keep_last(orders, order_batch(orders), "o_orderkey")


@check(
    "upsert_duplicate_keys",
    """WITH batch AS (
         SELECT user_id AS id, value, event_type FROM events
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
       SELECT coalesce(c.c_custkey, b.id) AS id, c.c_name AS name, b.value, b.event_type
       FROM customer c FULL OUTER JOIN batch b ON c.c_custkey = b.id""",
)
def upsert_duplicate_keys(spark, folder):
    """A batch with many rows per key: the last one is merged, nothing is multiplied."""
    base = load(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    events = load(spark, folder, "events")
    batch = events.select(F.col("user_id").alias("id"), "value", "event_type", "ts", "event_id")
    latest = keep_last(batch, "id", ["ts", "event_id"], unique_order=True).drop("ts", "event_id")
    return merge_columns(base, latest, "id")


# A batch of wider types, with null and repeated keys: the base decides the types.
WIDE_SQL = """WITH base AS (SELECT CAST(event_id AS INTEGER) AS id, CAST(floor(value + 0.5) AS INTEGER) AS score, event_type FROM events WHERE event_id % 3 = 0),
     batch AS (
       SELECT id, max_by(score, ts) AS score FROM (
         SELECT CASE WHEN event_id % 7 > 0 THEN event_id // 2 END AS id, CAST(floor(value * 2 + 0.5) AS BIGINT) AS score, epoch_us(ts) * 1000 + event_id % 2 AS ts
         FROM events) WHERE id IS NOT NULL GROUP BY id)
     SELECT CAST(coalesce(a.id, b.id) AS INTEGER) AS id,
       CAST(CASE WHEN b.id IS NULL THEN a.score ELSE b.score END AS INTEGER) AS score, a.event_type
     FROM base a FULL OUTER JOIN batch b ON a.id = b.id"""


def merge_wider(spark, folder, strategy):
    events = load(spark, folder, "events")
    base = events.where("event_id % 3 = 0").selectExpr("CAST(event_id AS INT) AS id", "CAST(floor(value + 0.5D) AS INT) AS score", "event_type")
    batch = events.selectExpr(
        "IF(event_id % 7 > 0, event_id DIV 2, NULL) AS id", "CAST(floor(value * 2 + 0.5D) AS BIGINT) AS score", "ts", "event_id % 2 AS odd"
    )
    latest = keep_last(batch, "id", ["ts", "odd"]).drop("ts", "odd")
    return merge_columns(base, latest, "id", None, strategy)


@check("upsert_wider_batch", WIDE_SQL)
def upsert_wider_batch(spark, folder):
    return merge_wider(spark, folder, "auto")


@check("upsert_wider_batch_full", WIDE_SQL)
def upsert_wider_batch_full(spark, folder):
    return merge_wider(spark, folder, "full_outer")


@check("upsert_wider_batch_lookup", WIDE_SQL)
def upsert_wider_batch_lookup(spark, folder):
    return merge_wider(spark, folder, "lookup")
