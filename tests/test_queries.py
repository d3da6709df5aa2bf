"""Every query of the core against its SQL on whole small tables."""

import pytest
from compare import connect, differences

from millrace.plans import catalogue

SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(spark, con, sf, catalogue.queries()[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalogue.queries()[name](spark, sf).count() > 0


def test_the_core_stands_alone():
    """Nothing of the core imports the package of corpus operators."""
    import pathlib

    import millrace

    root = pathlib.Path(millrace.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "llm" not in p.read_text(), p
