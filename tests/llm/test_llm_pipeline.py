"""The stages, each against what it must do to its own input."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import bpe, language, secrets
from threadloom.llm.decontaminate import leaks
from threadloom.llm.simhash import near_duplicates


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages, table):
    for before, after in stages[:-1]:
        assert after.columns == table("documents").columns


def test_language_stage(stages):
    before, after = stages[0]
    told = language.identify(before).collect()
    assert ids(after) == {r.doc_id for r in told if r.lang_pred != "und" and r.score >= 0.5}


def test_dedup_stage(stages):
    before, after = stages[1]
    found = near_duplicates(before).collect()
    assert ids(after) == {r.component_id for r in found} and after.count() == len(ids(after)) < before.count()


def test_decontamination_stage(stages, table):
    before, after = stages[2]
    assert ids(before) - ids(after) == ids(leaks(before, table("benchmark")))


def test_secret_stage(stages):
    before, after = stages[3]
    assert ids(before) == ids(after)
    assert not any(r.spans for r in secrets.find_secrets(after, rules=secrets.BASE).collect())
    old = {r.doc_id: r.text for r in before.collect()}
    for row in after.collect():
        assert row.n_chars == len(row.text)
        if row.text != old[row.doc_id]:
            kept = re.escape(row.text).replace(re.escape("[secret]"), ".+?")
            assert re.fullmatch(kept, old[row.doc_id], re.DOTALL)


def test_encoding_stage(stages):
    before, after = stages[4]
    texts = {r.doc_id: r.text for r in before.collect()}
    back = bpe.decode(after, corpus_pipeline.TOKENIZER).collect()
    assert {r.doc_id: r.decoded for r in back} == texts and all(r.n_tokens == len(r.token_ids) for r in back)


def test_run_equals_the_stages(spark, stages):
    got = {r.doc_id: r.token_ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: r.token_ids for r in stages[4][1].collect()}


def test_edges(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "plain words of text", "en", "a", 19), (2, "plain words of text", "en", "a", 19), (3, "token=abcdefgh12 here", "en", "b", 21)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == [(2, "plain words of text", 19), (3, "[secret] here", 13)]


EXTRA = "_row_hash _kept_id _Passages _lang_pred _lang_score _masked _spans spans passages lang_pred score".split()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_extra_columns_come_back(spark, stage):
    rows = [(i, f"plain words of text number {i} and nothing more", "en", "a", 40) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in EXTRA:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id")))
    docs = docs.withColumn("tags", F.create_map(F.lit("id"), F.col("doc_id")))
    got = stage[1](spark, docs, SF)
    assert got.columns == docs.columns
    after = got.collect()
    assert after
    for row in after:
        assert all(row[name] == f"{name}-{row.doc_id}" for name in EXTRA) and row.tags == {"id": row.doc_id}
