"""Arrow batches are bounded by bytes, so that a worker's memory does not grow with the texts of a task."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.operators.vocab import lemmatize
from threadloom.session import bound_batches
from threadloom.sources import ranges

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unbounded(spark):
    before = spark.conf.get(NAME)
    spark.conf.set(NAME, "64m")
    yield spark
    spark.conf.set(NAME, before)


def largest(df):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    return df.mapInArrow(run, "bytes long").agg(F.max("bytes")).first()[0]


def test_a_lower_bound_is_kept(unbounded):
    unbounded.conf.set(NAME, "1m")
    bound_batches(unbounded)
    assert unbounded.conf.get(NAME) == "1m"


def test_lemmas(unbounded):
    texts = unbounded.range(3_000).coalesce(1).select(F.repeat(F.lit("mice "), 2_000).alias("text"))
    lemmas = unbounded.sql("SELECT 'mice' AS word, 'mouse' AS lemma")
    got = lemmatize(texts, "text", lemmas, "map")
    assert got.agg(F.max(F.length("text"))).first()[0] == 2_000 * 6
    assert largest(texts) < 10 << 20


def test_byte_ranges(unbounded, tmp_path):
    texts = unbounded.range(3_000).coalesce(1).select(F.concat(F.lit('{"a": "'), F.repeat(F.lit("x"), 9_000), F.lit('"},')))
    texts.write.text(str(tmp_path / "t"))
    fragments = ranges.read_fragments(unbounded, str(tmp_path / "t"), ranges.JSON_ARRAY)
    assert largest(fragments.coalesce(1)) < 10 << 20
