"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF).toArrow()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows
    else:
        assert differences(got, duck.sql(sql).to_arrow_table()) == []


def test_entry(spark):
    assert contract.entry(spark).columns[:2] == ["game_id", "name"]
