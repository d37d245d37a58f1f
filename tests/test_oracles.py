"""Every registered query against its SQL twin on whole test tables."""

import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from workload.oracles import ORACLES
from workload.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# Results that may be empty on the smallest data but not on these.
NEVER_EMPTY = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", NEVER_EMPTY)
def test_query_matches_sql(spark, con, key):
    df = QUERIES[key](spark, FOLDER)
    assert differences(df, con, ORACLES[key]) == []
    assert df.limit(1).count() == 1


def test_entry_has_the_result_columns(spark):
    df = entry(spark)
    assert len(df.columns) == 41
    assert df.columns[:3] == ["region", "wdid", "facility_name"]
    assert df.count() > 0
