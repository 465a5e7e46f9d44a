"""The files that the import checks write and what an empty text becomes."""

import json
import pathlib

from checks.stores import foreign_csv, write_arrays
from threadloom.sources.files import import_csv, import_json_array


def arrays(path):
    return [json.loads(f.read_text()) for f in pathlib.Path(path).rglob("part-*")]


def test_arrays_are_bounded_and_grow_in_number(spark, tmp_path):
    rows = [(16 * i, "x" * (400 if i % 50 else 20_000), "en") for i in range(2_000)]  # one remainder by 16
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    write_arrays(docs, str(tmp_path / "few"))
    write_arrays(docs, str(tmp_path / "many"), array_bytes=20_000)
    few, many = arrays(tmp_path / "few"), arrays(tmp_path / "many")
    assert len(few) == 16 and max(map(len, few)) < 400
    assert len(many) > 60 and max(sum(len(r["text"]) for r in a) for a in many) < 150_000
    got = import_json_array(spark, str(tmp_path / "many"), docs.schema).select(*docs.columns)
    assert sorted(map(tuple, got.collect())) == rows


def test_empty_text_of_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('doc_id,text\n1,\n2,""\n3,x\n')
    got = import_csv(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], "doc_id long, text string").schema)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, None), (2, None), (3, "x")]


def test_csv_rows_without_text_are_read(spark, tmp_path):
    rows = [(1, "", "en"), (2, None, "fr"), (3, 'a "b",\nc', "en"), (4, "d", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = foreign_csv(spark, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, None), (2, None), (3, 'a "b",\nc'), (4, "d")]
