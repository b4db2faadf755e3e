"""Every registered query against its SQL on the driver tables."""

import pytest

from rxtally.checks.compare import connect, difference
from rxtally.checks.oracle import ORACLE
from rxtally.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
