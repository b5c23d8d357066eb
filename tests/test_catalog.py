"""Every registered query of the surveillance operators equals its SQL."""

import pytest

from lineagrid.plans import catalog

from .oracle import connect, same


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, data, con, name):
    same(catalog.queries()[name](spark, data), con, catalog.oracle_sql()[name])  # every one of these has SQL


def test_flagship(spark, data):
    assert catalog.flagship(spark, data).count() > 0


def test_entry_module():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert all(isinstance(v, str) for v in __spark_entry__.oracle_sql().values())
