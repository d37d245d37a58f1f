"""The text queries against their SQL twins on whole test tables."""

import os

import pytest
from compare import connect, differences

from culvert.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, con, key):
    assert differences(QUERIES[key](spark, FOLDER), con, ORACLES[key]) == []
