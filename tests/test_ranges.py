"""JSON arrays and CSV files cut at any byte, against the standard library's parsers."""

import csv
import io
import json
import random

import pytest

from threadloom.sources import ranges
from threadloom.sources.files import import_csv, import_json_array

SCHEMA = "id string, body string, n long, tags array<string>, inner struct<a: string, b: long>"
PIECES = ['"', "\\", "}", "{", "[", "]", ",", "\n", "é", "𝄞", "\\\\", '\\"', "a", "text", " ", '}"', '"}', "},{", "\r\n"]


@pytest.fixture(params=[37, 150, 4096, 1 << 27])
def split(spark, request):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield request.param
    spark.conf.set(key, before)


def words(rng, most=12):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


def tables(count, seed):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        row = {"id": f"r{i}", "body": words(rng, 400 if i == 7 else 12), "n": i}
        if i % 3:
            row["tags"] = [words(rng) for _ in range(rng.randint(0, 3))]
        if i % 4:
            row["inner"] = {"a": words(rng), "b": i}
        out.append(row)
    return out


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_json_array(spark, tmp_path, split, style):
    rows = tables(25, split)
    for n, part in enumerate((rows[:20], rows[20:], [])):
        (tmp_path / f"part {n}.json").write_text(json.dumps(part, **style) + "\n" * n)
    fragments = ranges.read_fragments(spark, str(tmp_path), ranges.JSON_ARRAY)
    if split <= 150:
        assert fragments.rdd.getNumPartitions() > 10
    got = import_json_array(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema).collect()
    want = [(r["id"], r["body"], r["n"], r.get("tags"), tuple(r["inner"].values()) if "inner" in r else None) for r in rows]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_csv(spark, tmp_path, split):
    rng = random.Random(split)
    rows = [(f"r{i}", words(rng, 300 if i == 5 else 12) if i % 6 else "", i) for i in range(30)]
    rows += [("id", "body", "3")]  # a row like a header, but for its number
    for n, (names, eol) in enumerate([(("id", "body", "n"), "\n"), (("n", "id", "body", "more\nthan"), "\r\n")]):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=eol)
        writer.writerow(names)
        for row in rows[n::2]:
            by = dict(zip(("id", "body", "n"), row))
            writer.writerow([by.get(name, "x") for name in names])
        (tmp_path / f"part {n}.csv").write_text(out.getvalue() if n else out.getvalue().removesuffix(eol), newline="")
    (tmp_path / "empty.csv").write_text("")
    got = import_csv(spark, str(tmp_path), spark.createDataFrame([], "id string, body string, n long").schema)
    assert set(got.columns) == {"id", "body", "n", "more\nthan"}
    want = sorted((i, b or None, int(n)) for i, b, n in rows)
    assert sorted((r.id, r.body, r.n) for r in got.collect()) == want


@pytest.mark.parametrize("text", ['[{"id": "a"}', '[{"id": "a}]', '{"id": "a"}', '[{"id": "a"}, 5]', "[null]", '[[{"id": "a"}]]', '[{"id": }]'])
def test_damaged_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="record|object|MALFORMED|FAILFAST"):
        import_json_array(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema).collect()


@pytest.mark.parametrize("text", ['id,n\na,"b\n', "\nid,n\na,1\n", "id,n\na,1,2\n", "id,n\na,x\n"])
def test_damaged_csv_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match="record|header|MALFORMED|FAILFAST"):
        import_csv(spark, str(tmp_path), spark.createDataFrame([], "id string, n long").schema).collect()


def test_many_ranges_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "_SENT", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = tables(25, 1)
        (tmp_path / "a.json").write_text(json.dumps(rows))
        got = import_json_array(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema).collect()
        assert sorted((r.id, r.body) for r in got) == sorted((r["id"], r["body"]) for r in rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
