"""Every query against its SQL on the smallest given tables."""

import pytest

from checks import ORACLE, QUERIES
from checks.verify import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLE:
        assert difference(got, con.execute(ORACLE[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
