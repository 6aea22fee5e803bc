import pytest
from compare import difference, second_engine
from conftest import SMALL

from sftprep.llm import checks, queries


@pytest.mark.parametrize("name", sorted(checks.CHECKS))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), second_engine(SMALL), checks.CHECKS[name]) is None
