"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as contract
from packetlens.plans.oracles import ORACLES
from packetlens.plans.registry import QUERIES
from checks import DATA, database, spark_rows, sql_rows

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["address_a", "address_b", "total", "avg", "count"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, con, name):
    got = spark_rows(contract.queries()[name](spark, SF))
    want = sql_rows(con, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(want[1]) > 0
    assert got[1] == want[1]
