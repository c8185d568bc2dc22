"""Every registered query against its SQL oracle, over whole tables."""

import pytest
from check import compare, open_tables

import __spark_entry__ as contract

@pytest.fixture(scope="module")
def connection(folder):
    with open_tables(folder) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, connection, folder, name):
    result = compare(spark, connection, folder, name)
    assert result.startswith("ok"), result
    assert "types" not in result, result


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "airline_code", "flight_year", "flight_month", "flights", "mean_fare", "holiday_flights",
    }


def test_every_query_has_an_oracle():
    assert set(contract.QUERIES) <= set(contract.oracle_sql()) & set(contract.queries())
