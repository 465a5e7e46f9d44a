"""Every registered query against its SQL, on the smallest tables."""

import pytest
from conftest import SF

import __spark_entry__ as entry_points
from checks import QUERIES
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    good, note = compare(spark, con, SF, name)
    assert good, note


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "title", "author", "created_utc", "score", "selftext", "domain"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
