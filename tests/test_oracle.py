"""Every registered query against its SQL oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry_module
import oracle
from presslake.workload.oracles import ORACLES
from presslake.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = oracle.actual(QUERIES[name](spark, SF_DIR))
    want = oracle.expected(duck, ORACLES[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "the query should not be empty on this data"


def test_entry(spark):
    top = entry_module.entry(spark).collect()
    assert len(top) == 20 and top[0].frequency >= top[-1].frequency
