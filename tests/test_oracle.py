"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as contract
import oracle
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_sql(spark, con, name):
    rows, bad = oracle.differences(spark, con, SF, name)
    assert not bad
    assert rows >= 0


def test_flagship_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
