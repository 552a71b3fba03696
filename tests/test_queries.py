"""Every registered query against its SQL twin."""

import oraclecheck
import pytest

import __spark_entry__ as entrypoint
from wattline.plans import queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oraclecheck.connect(SF)


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_equals_sql(spark, duck, name):
    assert oraclecheck.compare(spark, duck, name, SF) is None


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(entrypoint.oracle_sql())
    assert set(entrypoint.oracle_sql()) <= set(entrypoint.queries())


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0
