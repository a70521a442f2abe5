"""The training-data queries that SQL can express, against DuckDB on whole tables."""

import os

import pytest
from oracle_compare import compare, connect

from shiftledger.llm.oracles import ORACLES
from shiftledger.llm.queries import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None
