import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from threadloom.functions.scalars import (
    iso_to_timestamp,
    part,
    preview,
    timestamp_to_iso,
)
from threadloom.operators import filters
from threadloom.operators.transforms import add_fields, clean_fields, optional, records

START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
MICRO = dt.timedelta(microseconds=1)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_date_bounds_are_inclusive(spark, kind):
    moments = [START, END, START - MICRO, END + MICRO, None]
    rows = [(i, None if m is None else m.isoformat(sep=" ")) for i, m in enumerate(moments)]
    df = spark.createDataFrame(rows, "i int, s string")
    df = df.withColumn("created_utc", F.col("s").cast(kind))
    assert values(filters.by_date(df, start=START, end=END), "i") == [(0,), (1,)]
    assert values(filters.by_date(df, start=START), "i") == [(0,), (1,), (3,)]
    assert filters.by_date(df) is df


def test_date_aware_bound(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 02:00:00")], "i int, s string")
    df = df.withColumn("created_utc", F.col("s").cast("timestamp"))
    bound = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert values(filters.by_date(df, start=bound), "i") == [(2,)]


def test_date_text(frame):
    texts = ["2024-01-01T10:00:00", "junk", "", None, "2024-01-02", "2024-01", "2025-01-01"]
    df = frame(list(enumerate(texts)), "i int, created_utc string")
    assert values(filters.by_date(df, start=START, end=END), "i") == [(0,), (4,)]


@pytest.mark.parametrize(
    "text",
    [
        "2024-01-01", "2024-01-01T10", "2024-01-01 10:30", "2024-01-01T10:30:05",
        "2024-01-01T10:30:05.5", "2024-01-01T10:30:05,123456", "20240102", "20240102T10:30:05",
        "2024-01-01T10:30:05Z", "2024-01-01T10:30Z", "2024-01-01T10:30:05+02:00", "2024-01-01T10+02:00",
    ],
)
def test_iso_accepts_what_python_accepts(frame, text):
    want = dt.datetime.fromisoformat(text)
    if want.tzinfo:
        want = want.astimezone(dt.timezone.utc).replace(tzinfo=None)
    got = frame([(text,)], "t string").select(
        F.date_format(iso_to_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    assert got.first()[0] == want.isoformat(sep=" ", timespec="microseconds")


@pytest.mark.parametrize("text", ["2024", "2024-01", "2024-1-1", " 2024-01-01", "2024-13-01", "x", ""])
def test_iso_rejects_what_python_rejects(frame, text):
    with pytest.raises(ValueError):
        dt.datetime.fromisoformat(text)
    assert frame([(text,)], "t string").select(iso_to_timestamp(F.col("t"))).first()[0] is None


@pytest.mark.parametrize("micros", [0, 500_000, 1])
def test_timestamp_to_iso(spark, micros):
    moment = dt.datetime(2024, 3, 1, 4, 5, 6, micros)
    df = spark.createDataFrame([(moment.isoformat(),)], "t string")
    assert df.select(timestamp_to_iso(F.to_timestamp("t"))).first()[0] == moment.isoformat()


def test_score(frame):
    df = frame([(-1,), (0,), (1,), (None,)], "score int")
    assert values(filters.by_score(df, minimum=0), "score") == [(0,), (1,)]
    assert values(filters.by_score(df, maximum=0), "score") == [(-1,), (0,)]
    assert filters.by_score(df) is df
    nan = frame([(float("nan"),), (2.0,)], "score double")
    assert values(filters.by_score(nan, minimum=1), "score") == [(2.0,)]


def test_expr(frame):
    df = frame([(1, "a"), (2, "b"), (3, None)], "i int, s string")
    assert values(filters.by_expr(df, "i > 1"), "i") == [(2,), (3,)]
    assert values(filters.by_expr(df, F.col("i") == 1), "i") == [(1,)]
    assert values(filters.by_expr(df, lambda rows: rows["s"] == "b"), "i") == [(2,)]
    assert values(filters.by_expr(df, lambda rows: rows["s"].isna(), ["s"]), "i") == [(3,)]


def test_keywords_are_literal_substrings(frame):
    df = frame([(1, "A Deep Learning intro"), (2, "remodelled"), (3, "nothing"), (4, None), (5, "a.b")], "i int, title string")
    assert values(filters.by_keywords(df, ["deep learning", "model"]), "i") == [(1,), (2,)]
    assert values(filters.by_keywords(df, ["a.b"]), "i") == [(5,)]


def test_equality(frame):
    df = frame([(5, "x"), (10, None), (15, "x")], "score int, flair string")
    assert values(filters.by_equality(df, {"score": 10}), "score") == [(10,)]
    assert values(filters.by_equality(df, {"flair": None}), "score") == [(10,)]
    assert values(filters.by_equality(df, {"flair": "x", "score": 15}), "score") == [(15,)]
    assert values(filters.by_equality(df, None), "score") == [(10,), (15,), (5,)]
    with pytest.raises(ValueError):
        filters.by_equality(df, {"nope": 1})
    assert filters.by_equality(df, {"nope": 1}, on_unknown="ignore").count() == 3


def test_equality_on_time(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00' AS t UNION ALL SELECT TIMESTAMP'2024-01-02 00:00:00'")
    assert filters.by_equality(df, {"t": dt.datetime(2024, 1, 1, 10)}).count() == 1


def test_having(frame):
    df = frame([(1, None), (2, "a")], "i int, s string")
    assert values(filters.having(df, "i", "s"), "i") == [(2,)]


def test_derivations_see_the_original_row(frame):
    df = frame([(1,)], "a int")
    got = add_fields(df, {"a": "a + 1", "b": F.col("a") * 2, "c": lambda d: d["a"] - 1})
    assert got.select("a", "b", "c").first() == (2, 2, 0)


def test_clean_fields(frame):
    df = frame([(1, None), (2, ""), (3, "The Cat")], "id int, t string")
    got = clean_fields(df, ["t", "absent"])
    assert values(got, "id", "t") == [(1, None), (2, ""), (3, "cat")]


def test_lemmas(frame, spark):
    from threadloom.functions.text import TextOptions

    df = frame([(1, "two geese and mice geese"), (2, None), (3, "plain"), (4, "")], "id int, t string")
    from threadloom.operators.vocab import lemmatize

    lemmas = spark.createDataFrame(
        [("geese", "goose"), ("mice", "mouse"), ("geese", "zoose"), ("plain", "plain")], "word string, lemma string"
    )
    options = TextOptions(remove_stopwords=False, lemmatization=True)
    got = clean_fields(df, ["t"], options, lemmas)
    assert values(got, "id", "t") == [
        (1, "two goose and mouse goose"), (2, None), (3, "plain"), (4, ""),
    ]
    for strategy in ("map", "join"):
        other = lemmatize(df, "t", lemmas, strategy)
        assert values(other, "id", "t") == values(got, "id", "t")
    with pytest.raises(ValueError):
        lemmatize(df, "t", lemmas, "other")
    with pytest.raises(ValueError):
        clean_fields(df, ["t"], options)


def test_small_helpers(frame):
    from pyspark.sql import types as T

    df = frame([("t1_abc",), ("abc",)], "p string")
    assert [r[0] for r in df.select(part(F.col("p"), "_", 1)).collect()] == ["abc", None]
    assert df.select(preview(F.col("p"), 2)).first()[0] == "t1"
    assert df.select(optional(df, "zz", "int").alias("z")).first()[0] is None
    assert records(df, T.StructType([T.StructField("p", T.StringType())])).columns == ["p"]
