"""What the physical plans must and must not hold."""

import re

import pytest

from culvert.plans import attributes, facts
from workload import roles
from workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As for large inputs: nothing is small enough to broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_python_outside_the_outlier_test(spark):
    for key, query in QUERIES.items():
        if key in ("system_report", "summary_stats", "gesd_outliers"):
            continue  # run jobs; their results start at stored tables
        assert "Python" not in plan(query(spark, FOLDER)), key
        spark.catalog.clearCache()


def test_no_cross_join_but_the_one_row_bounds(spark, no_broadcast):
    for key in (
        "fanout_left_join",
        "weighted_fanout_count",
        "annual_counts",
        "anti_join_missing_report",
        "reporting_gap_both",
        "membership_flags",
        "active_orders",
        "system_attributes",
    ):
        text = plan(QUERIES[key](spark, FOLDER))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, key
    text = plan(QUERIES["dense_year_panel"](spark, FOLDER))
    assert text.count("BroadcastNestedLoopJoin") == 1


def test_picks_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["latest_per_system"](spark, FOLDER))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]


def test_feeds_are_hash_aggregated_before_the_shuffle(spark):
    t = roles.tables(spark, FOLDER)
    rollup = plan(facts.spill_rollup(t["new_spills"], t["old_spills"], roles.CONFIG))
    assert "SortAggregate" not in rollup and "partial_count" in rollup
    for part in (facts.report_facts(t["annual_reports"]), facts.questionnaire_facts(t["questionnaire"])):
        assert "SortAggregate" not in plan(part)


def test_attributes_shuffle_each_input_once(spark, no_broadcast):
    t = roles.tables(spark, FOLDER)
    rollup = facts.spill_rollup(t["new_spills"], t["old_spills"], roles.CONFIG)
    text = plan(attributes.system_facts(t, rollup, roles.CONFIG))
    # Facilities, reports, questionnaire: one each; spills: by group, then by id.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5


def test_filters_and_columns_reach_the_files(spark):
    text = plan(QUERIES["weighted_fanout_count"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in re.findall(r"ReadSchema: (\S+)", text)[0]
    text = plan(QUERIES["nonreporting_entities"](spark, FOLDER))
    schema = re.findall(r"ReadSchema: (\S+)", text)[0]
    assert "props" not in schema and "value" not in schema


def test_windows_never_hold_a_class(spark):
    for key in ("class_quartiles", "band_5yr", "gesd_candidates"):
        text = plan(QUERIES[key](spark, FOLDER))
        for partition in re.findall(r"Window \[.*?windowspecdefinition\((\w+)#", text):
            # The quantile window sees bracket points only, not rows.
            assert partition in ("wdid", "_g"), partition
        spark.catalog.clearCache()


def test_panels_stay_on_the_layout_of_the_rollup(spark, no_broadcast):
    from culvert.plans import job, spills

    b = job.base(roles.tables(spark, FOLDER), roles.CONFIG, job.Keeper())
    for rates in (
        spills.rates_5yr(spills.yearly_counts(b.weighted), roles.CONFIG),
        spills.rates_12mo(spills.month_counts(b.weighted), roles.CONFIG),
    ):
        text = plan(rates)
        window = text.index("Window [")
        between = text[window : text.index("SortMergeJoin", window)]
        assert "HashAggregate" in between and "Exchange" not in between
