"""Every registered query against its comparison SQL."""

import pytest

from compare import compare, connect
from pitwall.catalog.registry import load_all

QUERIES = load_all()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data, name):
    assert compare(spark, con, data, QUERIES[name]) is None


def test_contract():
    import __spark_entry__ as e

    assert e.FLAGSHIP in e.queries() and set(e.oracle_sql()) <= set(e.queries())
