"""Every registered query against its SQL counterpart, on whole tables."""

import pytest

import __spark_entry__ as spark_entry
import check_oracle
from ratinglens.plans import catalog, oracle

from .conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, connection, name):
    problem, count, _, _ = check_oracle.compare(spark, connection, SMALL, name)
    assert problem is None
    assert count > 0


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
