"""Chat, URL lists and sharding: edge rows and laws; their SQL is compared in test_llm_queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadloom.llm import chat, sharding, urls
from threadloom.operators.position import number_rows


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# --- chat


def test_perspectives(spark):
    rows = [("c", 0, "system", "S"), ("c", 1, "ann", "hi"), ("c", 2, "bob", "é!"), ("c", 3, "ann", None), ("d", 0, "system", "alone"), (None, 0, None, "x"), (None, None, "", "y")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").withColumn("part", F.lit("mine"))
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(df).collect()}
    assert set(got) == {("c", "ann"), ("c", "bob"), (None, "unknown")}
    ann = got["c", "ann"]
    assert ann.rendered == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob\né!<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    spans = [tuple(map(int, s.split(":"))) for s in ann.spans.split(",")]
    assert [ann.rendered[a:b] for a, b in spans] == ["hi<|im_end|>", "<|im_end|>"] and ann.trained_chars == 22
    assert got[None, "unknown"].rendered == "<|im_start|>assistant\ny<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert no_python(chat.rotate(df)) and chat.rotate(df.where("false")).collect() == []


def test_long_dialogues_are_cut(spark):
    df = spark.range(1000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'a', 'b') AS role", "repeat('w', 10) AS text")
    got = chat.rotate(df.union(df), max_turns=64).where("perspective = 'a'").orderBy("part").collect()
    assert [r.part for r in got] == list(range(32)) and sum(r.n_turns for r in got) == 2000 and max(r.n_turns for r in got) == 64


def test_numbering_has_no_gaps(spark):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, NULL, id % 2) AS g", "id % 7 AS k", "id")
    got = number_rows(df.repartition(9), ["g"], [F.col("k").asc(), F.col("id").desc()])
    for group in (None, 0, 1):
        rows = got.where(F.col("g").eqNullSafe(F.lit(group))).orderBy("position").collect()
        assert [r.position for r in rows] == list(range(1, len(rows) + 1))
        assert [(r.k, -r.id) for r in rows] == sorted((r.k, -r.id) for r in rows)


def test_equal_rows_are_cut_over_tasks(spark):
    """A third of equal rows in group and order is not the work of one task."""
    df = spark.range(9000).selectExpr("'g' AS g", "IF(id % 3 = 0, 0, id) AS k").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(df, ["g"], [F.col("k").asc()])
        assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 9001))
        dealt = df.withColumn("t", F.monotonically_increasing_id()).repartitionByRange("g", "k", "t").where("k = 0")
        assert dealt.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# --- URL lists


def day(text):
    return dt.date.fromisoformat(text)


def test_lists_as_of_the_fetch(spark):
    entries = spark.createDataFrame(
        [("spam", "block", "host", "bad.org", "add", day("2024-02-01")), ("spam", "block", "host", "bad.org", "add", day("2024-02-01")),
         ("spam", "block", "host", "bad.org", "remove", day("2024-03-01")), ("spam", "block", "host", "bad.org", "add", day("2024-05-01")),
         ("ok", "allow", "url", "www.bad.org/fine", "add", day("2024-05-01")), ("x", "block", "host", None, "add", day("2024-01-01")),
         ("x", "block", "host", "same.org", "add", day("2024-01-01")), ("x", "block", "host", "same.org", "remove", day("2024-01-01")),
         ("x", "block", "host", "d.example", "add", None)],
        "list string, effect string, kind string, pattern string, action string, dated date",
    )
    cases = [
        ("http://www.bad.org/a", "2024-01-31", False), ("http://www.bad.org/a", "2024-02-01", True), ("http://bad.org", "2024-02-29", True),
        ("http://bad.org", "2024-03-01", False), ("https://user@WWW.Bad.org:80/x?y#z", "2024-06-01", True), ("http://www.bad.org/fine/?q", "2024-06-01", False),
        ("http://notbad.org", "2024-06-01", False), ("http://same.org", "2024-06-01", False), (None, "2024-06-01", False), ("nonsense", "2024-06-01", False),
        ("http://bad.org", None, False), ("http://d.example", "2024-06-01", False), ("http://bad.org", "2024-06-01", True), ("http://bad.org", "2024-06-01", True),
    ]
    captures = spark.createDataFrame([(u, d and day(d), w, 5) for u, d, w in cases], "url string, fetched_on date, want boolean, blocks int")
    got = urls.filter_urls(captures, entries)
    rows = got.collect()
    assert len(rows) == len(cases) and all(r.blocked == r.want for r in rows)
    assert no_python(got) and urls.filter_urls(captures.where("false"), entries).collect() == []
    assert not any(r.blocked for r in urls.filter_urls(captures, entries.where("false")).collect())


# --- sharding


@pytest.mark.parametrize("count", [0, 1, 23, 24, 25, 1000])
def test_shards_are_level(spark, count):
    docs = spark.range(count).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "IF(id % 5 = 0, NULL, concat('é', id)) AS text", "9 AS shard", "'x' AS slot")
    got = sharding.shard_documents(docs)
    rows = got.collect()
    assert len(rows) == count and no_python(got)
    slots = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_shard_sizes_and_checksums(spark):
    import zlib

    docs = spark.createDataFrame([(1, "é"), (2, None), (3, ""), (None, "x" * 100_000), (1, "é")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.size, r.text_crc32) for r in sharding.shard_documents(docs).collect())
    want = [("1", 10, zlib.crc32("é".encode()))] * 2 + [("2", 8, 0), ("3", 8, 0), ("None", 100_008, zlib.crc32(b"x" * 100_000))]
    assert got == want


def test_order_is_shuffled_and_files_hold_it(spark, tmp_path):
    docs = spark.range(2400).selectExpr("id AS doc_id", "id AS size", "map('k', id) AS extra")
    shuffled = sharding.external_shuffle(docs, "size")
    sharding.write_shards(shuffled, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 2400 and back.select("doc_id").distinct().count() == 2400
    order = [r.doc_id for r in back.orderBy("shard", "slot").collect()]
    assert abs(sum(a < b for a, b in zip(order, order[1:])) - 1200) < 120 and order != sorted(order)
    other = [r.doc_id for r in sharding.external_shuffle(docs, "size", seed=1).orderBy("shard", "slot").collect()]
    assert order != other


def test_a_third_of_equal_rows_is_spread(spark):
    docs = spark.range(3000).selectExpr("IF(id < 1000, 1, id) AS doc_id", "'same' AS text")
    shards = sharding.shard_documents(docs).where("doc_id = 1").groupBy("shard").count().collect()
    assert len(shards) == 24 and max(r["count"] for r in shards) < 100
