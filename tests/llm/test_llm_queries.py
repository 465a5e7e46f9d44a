"""Every registered query: against its SQL, or complete over its table."""

import pytest
from conftest import SF

from checks.compare import compare, connect
from threadloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    good, note = compare(spark, connect(SF), SF, name, QUERIES, ORACLES)
    assert good, note


def test_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("number", [1, 2, 3, 4, 6, 10])
def test_one_row_per_document(spark, table, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    ids = [r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in table("documents").select("doc_id").collect())
