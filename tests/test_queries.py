"""Every registered query against its SQL on the driver's tables."""

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
ORACLE = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, con, name):
    result = spark_entry.queries()[name](spark, SF)
    if name in ORACLE:
        assert compare(con, result, ORACLE[name]) is None
    else:
        assert len(result.collect()) > 0


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["mmsi", "latitude", "longitude", "name", "ship_type"]
