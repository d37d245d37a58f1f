"""One asset, one name and one facility hold a third of all rows."""

import duckdb
import pytest
from compare import TABLES, connect, differences

from workload.oracles import ORACLES
from workload.registry import QUERIES

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey)",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("hot")
    for t in TABLES:
        select = HOT.get(t, "SELECT *")
        duckdb.execute(f"COPY ({select} FROM '{SOURCE}/{t}.parquet') TO '{path}/{t}.parquet'")
    return str(path)


@pytest.mark.parametrize(
    "key",
    [
        "clean_spills_new",
        "clean_spills_old",
        "active_orders",
        "under_enforcement",
        "fanout_left_join",
        "weighted_fanout_count",
        "annual_counts",
        "system_attributes",
        "latest_per_system",
        "first_per_key",
        "source_label",
        "stage_audit",
        "enforcement_summary",
        "reporting_gap_both",
        "rolling_12mo",
        "band_5yr",
        "gesd_outliers",
        "system_report",
    ],
)
def test_hot_keys_keep_results_whole(spark, folder, key):
    assert differences(QUERIES[key](spark, folder), connect(folder), ORACLES[key]) == []


def test_hot_key_leaves_map_tasks_as_few_rows(spark, folder):
    """Rows shuffled for the hot asset do not grow with its raw rows."""
    from culvert.plans import facts
    from workload import roles

    t = roles.tables(spark, folder)
    rollup = facts.spill_rollup(t["new_spills"], t["old_spills"], roles.CONFIG)
    hot = rollup.where("wdid = '7'")
    raw = t["new_spills"].unionByName(t["old_spills"]).where("wdid = '7'").count()
    assert raw > 400 and hot.count() < raw
    # At most one row per feed, month, type and status.
    assert hot.groupBy("feed", "month", "spill_type", "status", "in_scope").count().where("count > 1").count() == 0
