"""Every registered query beside its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in ORACLES])
def test_matches_sql(spark, con, sf, name):
    result = compare(spark, con, entry.queries()[name], ORACLES[name], sf)
    assert result.startswith("ok"), result
    assert "types" not in result, result


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns
    assert df.count() > 0
