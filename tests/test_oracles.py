import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert differences(df, con, ORACLES[name]) == []


def test_entry(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.count() == 1000
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_no_nested_output(spark, sf):
    for name, query in QUERIES.items():
        if not name.startswith(("refresh", "incremental", "stream")):
            assert all(t[1] not in ("array", "struct", "map") for t in query(spark, sf).dtypes), name
