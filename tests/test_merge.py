import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from threadloom.operators.dedup import keep_last
from threadloom.operators.upsert import append_keep_last, merge_columns, replace_rows

STRATEGIES = ("full_outer", "lookup", "auto")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last(frame):
    df = frame([("a", 1, 0), ("b", 2, 1), ("a", 9, 2), (None, 3, 3)], "id string, score int, seq int")
    assert values(keep_last(df, "id", ["seq"]), "id", "score") == [("a", 9), ("b", 2)]


def test_keep_last_ties_do_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("k"), F.lit(1).alias("seq"), F.col("id").alias("v")
    )
    first = values(keep_last(df.repartition(3), "k", ["seq"]), "k", "v")
    second = values(keep_last(df.repartition(11, "v"), "k", ["seq"]), "k", "v")
    assert first == second and len(first) == 7


def test_keep_last_trims_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("id"), F.col("id").alias("seq"))
    text = plan(keep_last(df, "id", ["seq"], unique_order=True))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:] and "Partial" in text[shuffle:]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=25))
def test_keep_last_against_a_dictionary(spark, rows):
    numbered = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "id int, v int, seq int")
    once = keep_last(df, "id", ["seq"])
    assert values(once, "id", "v") == sorted({k: v for k, v in rows}.items(), key=repr)
    assert values(keep_last(once, "id", ["seq"]), "id", "v") == values(once, "id", "v")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merge_columns(frame, strategy):
    base = frame([("a", 1, 2), ("b", 3, 4), ("n", 7, 8)], "id string, x int, y int")
    updates = frame([("a", 4, 0), ("a", 5, 1), ("n", None, 2), ("c", 6, 3)], "id string, x int, seq int")
    latest = keep_last(updates, "id", ["seq"]).drop("seq")
    got = merge_columns(base, latest, strategy=strategy)
    assert values(got, "id", "x", "y") == [("a", 5, 2), ("b", 3, 4), ("c", 6, None), ("n", None, 8)]
    again = merge_columns(got, latest, strategy=strategy)
    assert values(again, "id", "x", "y") == values(got, "id", "x", "y")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merge_adds_new_columns_and_last_row_wins(frame, strategy):
    base = frame([("a", 1)], "id string, x int")
    updates = frame([("a", 4, "p"), ("a", 5, "q")], "id string, seq int, z string")
    got = merge_columns(base, updates, order_by=["seq"], strategy=strategy)
    assert got.select("id", "x", "seq", "z").collect() == [("a", 1, 5, "q")]


def test_merge_small_batch_does_not_shuffle_the_base(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.range(50_000).select("id", F.col("id").alias("x"), F.lit("p").alias("y")).write.parquet(path)
    base = spark.read.parquet(path)
    updates = spark.sql("SELECT * FROM VALUES (1L, 5L), (60000L, 6L) AS t(id, x)")
    got = merge_columns(base, updates)
    text = plan(got)
    assert "FullOuter" not in text
    assert "Exchange hashpartitioning" not in text.split("LeftOuter")[1].split("FileScan")[0]
    assert got.count() == 50_001
    assert got.where("id = 1").select("x", "y").first() == (5, "p")


def test_unknown_strategy(frame):
    df = frame([("a", 1)], "id string, x int")
    with pytest.raises(ValueError):
        merge_columns(df, df, strategy="other")


def test_replace_rows(frame):
    base = frame([("a", 1, 2), ("b", 3, 4)], "id string, x int, y int")
    updates = frame([("a", 5)], "id string, x int")
    assert values(replace_rows(base, updates), "id", "x", "y") == [("a", 5, None), ("b", 3, 4)]


@pytest.mark.parametrize("unique", [False, True])
def test_append_keep_last(frame, unique):
    base = frame([("a", 1)], "id string, x int")
    updates = frame([("a", 2), ("b", 3)], "id string, x int")
    got = append_keep_last(base, updates, base_is_unique=unique)
    assert values(got, "id", "x") == [("a", 2), ("b", 3)]


def test_append_removes_duplicates_of_the_base(frame):
    base = frame([("a", 1, 0), ("a", 2, 1), (None, 9, 2)], "id string, x int, seq int")
    updates = frame([("b", 3, 0)], "id string, x int, seq int")
    assert values(append_keep_last(base, updates, order_by=["seq"]), "id", "x") == [("a", 2), ("b", 3)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(0, 6), st.integers(0, 9), max_size=6),
    st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 9))), max_size=10),
)
def test_upserts_against_a_dictionary(spark, base, batch):
    b = spark.createDataFrame(list(base.items()), "id int, x int")
    u = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "id int, x int, seq int")
    want = sorted({**base, **dict(batch)}.items(), key=repr)
    latest = keep_last(u, "id", ["seq"]).drop("seq")
    for strategy in ("full_outer", "lookup"):
        assert values(merge_columns(b, latest, strategy=strategy), "id", "x") == want
    assert values(replace_rows(b, u, order_by=["seq"]), "id", "x") == want
    assert values(append_keep_last(b, u, order_by=["seq"]), "id", "x") == want
