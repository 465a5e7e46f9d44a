import datetime as dt
import json

import pytest
from conftest import values
from pyspark.sql import functions as F, types as T

from threadloom.operators.metrics import StepMetrics
from threadloom.plans.clean import clean_comments, clean_posts
from threadloom.plans.prepare import prepare_for_analysis
from threadloom.plans.run import run
from threadloom.schemas import COMMENTS, POSTS, conform
from threadloom.session import shared_dir, size_shuffles, work_path
from threadloom.sources.files import import_csv, import_json_array
from threadloom.sources.normalize import normalize_comments, normalize_community, normalize_posts
from threadloom.sources.store import create_store, reconcile, split_valid
from threadloom.streaming.flow import clean_stream, upsert_stream

FORMATS = ("table", "json", "csv")
NOTES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("body", T.StringType(), True),
        T.StructField("score", T.IntegerType(), True),
        T.StructField("seen", T.TimestampType(), True),
    ]
)
TEXTS = [None, "", "NA", 'a\n"b",c', " x ", "a\\", "c\r\nd", "null", "é²", "'", '"', ","]


def raw_post(i, **changes):
    row = {
        "id": f"p{i}", "title": f"The Title {i}", "author": "ann", "created_utc": 1_700_000_000.5 + i,
        "score": i, "upvote_ratio": 0.9, "num_comments": 1, "url": "u", "selftext": "Some Text!",
        "is_self": True, "permalink": "l", "link_flair_text": "f", "domain": "d", "is_video": False,
        "is_original_content": None, "subreddit": "s",
    }
    return {**row, **changes}


RAW_POST = (
    "id string, title string, author string, created_utc double, score int, upvote_ratio double, "
    "num_comments int, url string, selftext string, is_self boolean, permalink string, "
    "link_flair_text string, domain string, is_video boolean, is_original_content boolean, subreddit string"
)
RAW_COMMENT = (
    "id string, post_id string, parent_id string, author string, created_utc double, score int, "
    "body string, permalink string, depth int, is_submitter boolean, subreddit string"
)


@pytest.fixture
def raw_posts(spark):
    def make(*rows):
        return spark.createDataFrame([raw_post(**r) for r in rows], RAW_POST)

    return make


@pytest.fixture
def raw_comments(spark):
    rows = [
        ("c1", "p1", "t3_p1", None, 1_700_000_100.0, 4, "The Body", None, 0, False, "s"),
        ("c2", "p1", "t1_c1", "bob", 1_700_000_200.0, -4, "Another", None, 1, True, "s"),
        ("c3", "p9", "t3_p9", "", 1_700_000_300.0, 1, "else", None, 0, True, "s"),
    ]
    return spark.createDataFrame(rows, RAW_COMMENT)


def test_normalize_posts(raw_posts):
    got = normalize_posts(raw_posts({"i": 1}, {"i": 2, "author": None})).orderBy("id").collect()
    assert [r.author for r in got] == ["ann", "[deleted]"] and got[0].flair == "f"
    assert got[0].created_utc.replace(tzinfo=None) is not None
    assert list(got[0].asDict()) == POSTS.names


def test_normalize_keeps_the_instant(raw_posts):
    got = normalize_posts(raw_posts({"i": 0})).select(F.date_format("created_utc", "yyyy-MM-dd HH:mm:ss.SSS"))
    assert got.first()[0] == "2023-11-14 22:13:20.500"


def test_normalize_comments(raw_comments):
    got = {r.id: r for r in normalize_comments(raw_comments).collect()}
    assert (got["c1"].parent_id, got["c1"].author) == ("p1", "[deleted]")
    assert (got["c2"].parent_id, got["c2"].author) == ("c1", "bob")
    assert got["c3"].author == "[deleted]"
    fixed = normalize_comments(raw_comments.drop("post_id"), "px")
    assert {r.post_id for r in fixed.collect()} == {"px"}


def test_normalize_community(spark):
    raw = spark.createDataFrame(
        [("x", "name", "t", "d", "pd", 5, 0.0, False, "/n")],
        "id string, display_name string, title string, description string, public_description string, "
        "subscribers int, created_utc double, over18 boolean, url string",
    )
    assert normalize_community(raw).first().name == "name"


def test_conform(frame):
    with pytest.raises(ValueError):
        conform(frame([("a",)], "id string"), POSTS)


@pytest.mark.parametrize("fmt", FORMATS)
def test_round_trip_loses_nothing(spark, fmt):
    store = create_store(spark, fmt.upper(), work_path(spark, "notes"), schemas={"notes": NOTES})
    rows = [(str(i), t, i, dt.datetime(2024, 1, 1, 2, 3, 4, 123456 if i % 2 else 0)) for i, t in enumerate(TEXTS)]
    rows += [("1e5", "x", None, None), ("007", "y", 1, None)]
    df = spark.createDataFrame(rows, relaxed_notes())
    store.save("notes", df)
    assert values(store.read("notes"), "*") == values(df, "*")


def relaxed_notes():
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in NOTES])


def test_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        create_store(spark, "XML", str(tmp_path))
    assert create_store(spark, "JSON", str(tmp_path)).kind == "json"
    assert create_store(spark, "SQLite", str(tmp_path)).kind == "parquet"


@pytest.mark.parametrize("fmt", FORMATS)
def test_missing_store_is_empty(spark, tmp_path, fmt):
    store = create_store(spark, fmt, str(tmp_path / "none"))
    assert store.posts().count() == 0 and store.comments().columns == COMMENTS.names
    assert store.version("posts") is None


EXPECTED = {
    "table": [("a", "kept", 5), ("b", "B", 2), ("c", None, 7)],
    "json": [("a", None, 5), ("b", "B", 2), ("c", None, 7)],
    "csv": [("a", None, 5), ("b", "B", 2), ("c", None, 7)],
}


@pytest.mark.parametrize("fmt", FORMATS)
@pytest.mark.parametrize("max_parts", [0, 1, 8])
def test_upsert(spark, fmt, max_parts):
    store = create_store(spark, fmt, work_path(spark, "up"), schemas={"notes": NOTES}, max_parts=max_parts)
    first = spark.createDataFrame([("a", "kept", 1), ("b", "B", 2)], "id string, body string, score int")
    second = spark.createDataFrame([("a", 4), ("a", 5), ("c", 7)], "id string, score int")
    store.save("notes", first)
    for _ in range(2):
        store.save("notes", second, order_by=["score"])
        assert values(store.read("notes"), "id", "body", "score") == EXPECTED[fmt]
    assert store.version("notes") == 3
    assert values(store.read("notes", {"score": 2}), "id") == [("b",)]
    assert store.read("notes", version=1).count() == 2
    store.forget("notes")
    assert len(store._folders("notes")) == {0: 1, 1: 1, 8: 3}[max_parts]
    assert values(store.read("notes"), "id", "body", "score") == EXPECTED[fmt]
    with pytest.raises(ValueError):
        store.save("notes", second.withColumn("odd", F.lit(1)))


def test_small_batch_does_not_rewrite_the_table(spark):
    store = create_store(spark, "table", work_path(spark, "parts"), schemas={"notes": NOTES})
    many = spark.range(1000).selectExpr("CAST(id AS STRING) AS id", "'b' AS body", "CAST(id AS INT) AS score")
    store.save("notes", many, order_by=None)
    number = store.save("notes", spark.createDataFrame([("7", -1), ("new", 1)], "id string, score int"))
    part = spark.read.parquet(f"{store.root}/notes/{store._folders('notes')[number]}")
    assert values(part, "id", "body", "score") == [("7", "b", -1), ("new", None, 1)]
    assert store.read("notes").count() == 1001
    assert values(store.read("notes", {"score": -1}), "id") == [("7",)]


def test_parts_are_gathered(spark):
    """Small batches into a large table are summed; only a large share rewrites it."""
    store = create_store(spark, "table", work_path(spark, "sums"), schemas={"notes": NOTES}, max_parts=2)
    many = spark.range(200_000).selectExpr("CAST(id AS STRING) AS id", "CAST(uuid() AS STRING) AS body")
    store.save("notes", many, order_by=None)
    kinds = []
    for i in range(7):
        batch = spark.createDataFrame([("7", i), (f"new{i}", i)], "id string, score int")
        number = store.save("notes", batch)
        kinds.append(store._folders("notes")[number].partition("-")[0])
        assert store.read("notes").count() == 200_001 + i
        assert store.read("notes", {"id": "7"}).first().score == i
    assert kinds == ["part", "part", "sum", "part", "sum", "part", "sum"]
    assert values(store.read("notes", {"score": 2}), "id") == [("new2",)]
    large = many.where("id < '6'").withColumn("score", F.lit(5))
    numbers = [store.save("notes", large, order_by=None) for _ in range(2)]
    kinds = [store._folders("notes")[n].partition("-")[0] for n in numbers]
    assert kinds == ["part", "full"]
    assert store.read("notes").count() == 200_007


def test_damaged_files_are_errors(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"id": "a", "score": 1}, {"id": ')
    with pytest.raises(Exception):
        import_json_array(spark, str(tmp_path / "bad.json"), NOTES).collect()
    (tmp_path / "bad.csv").write_text("id,score\na,notanumber\n")
    with pytest.raises(Exception):
        import_csv(spark, str(tmp_path / "bad.csv"), NOTES).collect()


def test_first_save_has_one_row_per_key(spark):
    store = create_store(spark, "csv", work_path(spark, "dup"), schemas={"notes": NOTES})
    store.save("notes", spark.createDataFrame([("a", 1), ("a", 2)], "id string, score int"), order_by=["score"])
    assert values(store.read("notes"), "id", "score") == [("a", 2)]


def test_broken_batch_changes_nothing(spark, raw_posts):
    store = create_store(spark, "table", work_path(spark, "atomic"))
    good = normalize_posts(raw_posts({"i": 1}))
    store.save_posts(good)
    bad = normalize_posts(raw_posts({"i": 2}, {"i": 3, "title": None}))
    with pytest.raises(Exception, match="required values missing"):
        store.save_posts(bad)
    assert values(store.posts(), "id") == [("p1",)]
    with pytest.raises(Exception, match="required values missing"):
        store.save_posts(spark.createDataFrame([("new", 1)], "id string, score int"))
    store.save_posts(spark.createDataFrame([("p1", 77)], "id string, score int"))
    assert values(store.posts(), "id", "score", "title") == [("p1", 77, "The Title 1")]


def test_split_valid(raw_posts):
    rows = normalize_posts(raw_posts({"i": 1}, {"i": 2, "title": None, "url": None}))
    valid, rejected = split_valid(rows, POSTS)
    assert values(valid, "id") == [("p1",)]
    assert rejected.select("reject_reasons").first()[0] == ["title", "url"]


def test_reconcile(frame):
    a = frame([("x",), ("y",)], "id string")
    b = frame([("y",), ("z",), ("w",)], "id string")
    assert tuple(reconcile(a, b).first()) == (2, 3, 1, 2)
    assert tuple(reconcile(a.limit(0), a.limit(0)).first()) == (0, 0, 0, 0)


def test_foreign_files(spark, tmp_path):
    array = [
        {"id": "a", "body": "x\ny", "score": 1, "seen": "2024-01-01T10:00:00"},
        {"id": "b", "score": 2, "seen": "2024-01-01T10:00:00.123456", "extra": 1},
    ]
    (tmp_path / "n.json").write_text(json.dumps(array, indent=2))
    got = import_json_array(spark, str(tmp_path / "n.json"), NOTES)
    assert values(got, "id", "body", "score") == [("a", "x\ny", 1), ("b", None, 2)]
    micros = got.where("id = 'b'").select(F.date_format("seen", "ss.SSSSSS")).first()[0]
    assert micros == "00.123456"
    (tmp_path / "n.csv").write_text('score,id,body,seen\n1,007,"a ""q"",\nb",2024-01-01 10:00:00\n,1e5,,\n')
    got = import_csv(spark, str(tmp_path / "n.csv"), NOTES)
    assert values(got, "id", "body", "score") == [("007", 'a "q",\nb', 1), ("1e5", None, None)]


# Plans -------------------------------------------------------------------------


def test_clean_posts_dedups_before_filtering(spark, raw_posts):
    df = normalize_posts(
        raw_posts({"i": 1, "score": 9}, {"i": 1, "score": 1, "created_utc": 1_800_000_000.0}, {"i": 7})
    )
    got = clean_posts(df, min_score=5)
    assert values(got, "id", "title", "selftext") == [("p7", "title 7", "text")]
    assert values(clean_posts(df, remove_duplicates=False, min_score=5), "score") == [(7,), (9,)]
    plain = clean_posts(df, clean_title=False, clean_selftext=False)
    assert values(plain, "id", "title") == [("p1", "The Title 1"), ("p7", "The Title 7")]


def test_clean_comments_and_metrics(raw_comments):
    metrics = StepMetrics()
    start = dt.datetime(2023, 11, 14)
    got = clean_comments(normalize_comments(raw_comments), min_score=0, start_date=start, metrics=metrics)
    assert values(got, "id", "body") == [("c1", "body"), ("c3", "else")]
    assert metrics.rows() == {"input": 3, "deduplicated": 3, "date": 3, "score": 2}
    assert metrics.removed() == {"deduplicated": 0, "date": 0, "score": 1}


def test_prepare_for_analysis(raw_posts, raw_comments):
    got = prepare_for_analysis(normalize_posts(raw_posts({"i": 1})), normalize_comments(raw_comments))
    assert got["posts"].columns == POSTS.names and got["comments"].count() == 3


@pytest.mark.parametrize("fmt", FORMATS)
@pytest.mark.parametrize("clean", [False, True])
def test_run(spark, raw_posts, raw_comments, fmt, clean):
    store = create_store(spark, fmt, work_path(spark, "run"))
    posts = raw_posts({"i": 1}, {"i": 2}, {"i": 3})
    report = run(posts, raw_comments, store, limit=2, sort_by="top", time_filter="all", clean_text=clean)
    assert tuple(report["posts"].first()) == (2, 2, 0, 0)
    assert tuple(report["comments"].first()) == (0, 0, 0, 0)
    report = run(posts, raw_comments, store, sort_by="new", min_score=1 if clean else None)
    assert tuple(report["posts"].first()) == (3, 3, 0, 0)
    assert tuple(report["comments"].first())[:3] == ((1, 1, 0) if clean else (2, 2, 0))
    assert store.posts({"id": "p1"}).first().title == "The Title 1"


def test_shared_folder_follows_the_session(spark):
    assert work_path(spark, "x").startswith(shared_dir(spark))


def test_shuffles_are_sized_by_input(spark, table):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(table("documents")) == int(before)
        unknown = spark.createDataFrame([(1,)], "i int")
        assert size_shuffles(unknown) == int(before)
        assert size_shuffles(table("documents"), per_task=1000) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# Streaming -----------------------------------------------------------------------


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    schema = "id string, body string, score int, seen timestamp"

    def drop(name, rows):
        spark.createDataFrame(rows, "id string, body string, score int").withColumn(
            "seen", F.lit("2024-01-01").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(str(source))

    store = create_store(spark, "json", work_path(spark, "stream"), schemas={"notes": NOTES})
    checkpoint = work_path(spark, "stream-state")

    def consume():
        stream = spark.readStream.schema(schema).parquet(str(source))
        cleaned = clean_stream(stream, ["body"], min_score=0, created="seen", start_date=dt.date(2023, 1, 1))
        upsert_stream(cleaned, store, "notes", checkpoint, ["score"], available_now=True).awaitTermination(120)

    drop("one", [("a", "The Cat", 1), ("a", "The Dog", 2), ("b", "low", -1)])
    consume()
    assert values(store.read("notes"), "id", "body", "score") == [("a", "dog", 2)]
    drop("two", [("a", "New!", 0), ("c", "C", 5)])
    consume()
    assert values(store.read("notes"), "id", "body", "score") == [("a", "new", 0), ("c", "c", 5)]
    before = store.version("notes")
    consume()
    assert store.version("notes") == before


def test_contents_are_reconciled(spark):
    from threadloom.sources.store import reconcile_rows

    schema = "id string, a string, b int"
    rows = [("k%d" % i, "x", i) for i in range(300)] + [("twice", "x", 1)] * 2 + [(None, "n", 1), ("null", None, 1)]
    want = spark.createDataFrame(rows, schema)
    assert reconcile_rows(want, want.repartition(5)).collect() == []
    other = [r for r in rows if r[0] not in ("k7", "twice", "null")] + [("more", "x", 1), ("twice", "x", 1), ("null", "x", None)]
    other[other.index(("k9", "x", 9))] = ("k9", None, 9)
    other[other.index((None, "n", 1))] = (None, "n", 2)
    for bits in (16, 1):
        got = {r.id: r.state for r in reconcile_rows(want, spark.createDataFrame(other, schema), bits=bits).collect()}
        assert got == {"k7": "missing", "more": "surplus", "twice": "changed", "k9": "changed", None: "changed", "null": "changed"}
    assert {r.state for r in reconcile_rows(want.where("id = 'k1'"), want.where("false")).collect()} == {"missing"}
    with pytest.raises(ValueError):
        reconcile_rows(want.selectExpr("id", "map('a', 1) AS m"), want)
