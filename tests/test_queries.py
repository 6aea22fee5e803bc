import __spark_entry__ as entry_points
import pytest
from compare import difference, second_engine
from conftest import SMALL

from sftprep.plans import catalogue, checks

QUERIES = catalogue.QUERIES
CHECKS = checks.CHECKS


@pytest.fixture(scope="module")
def db():
    return second_engine(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.columns == ["rec_id", "split", "text"] and rows.count() == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SMALL), db, CHECKS[name]) is None
