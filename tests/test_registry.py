import pytest

import __spark_entry__ as driver
from tests.check_registry import compare, connect
from vitrina.registry.oracles import oracles
from vitrina.registry.queries import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = REGISTRY, oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 18
    assert tuple(rows[0]) == ("Genre8", 85, 2.6626, 2.66)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF) is None
