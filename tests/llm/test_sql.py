"""Every query of the package with SQL against it, on whole small tables."""

import pytest
from compare import connect, differences

from millrace.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf01, name):
    assert differences(spark, connect(sf01), sf01, queries.queries()[name], SQL[name]) is None
