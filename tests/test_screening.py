"""Traps of the rules on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from small import by_id, day, facility, month, new_spill, old_spill, order, tables

from culvert.config import REASON_BOTH, REASON_SPILLS, ScreeningConfig
from culvert.plans import enforcement, job, report, reporting, screen, spills, system_attributes
from culvert.plans.facts import systems

CFG = ScreeningConfig()


def summarise(spark, cfg=CFG, **rows):
    b = job.base(tables(spark, **rows), cfg, job.Keeper())
    return by_id(report.spill_summary(b.weighted), "total_spills")


def test_reports_multiply_spills(spark):
    rows = {
        "facilities": [facility("A"), facility("B")],
        "new_spills": [new_spill("A", "2022-03-01"), new_spill("B", "2022-03-01"), new_spill("X", "2022-03-01")],
        "annual_reports": [("A", y, 1.0, 1.0) for y in (2021, 2022, 2023)],
    }
    assert summarise(spark, **rows) == {"A": 3, "B": 1}
    assert summarise(spark, ScreeningConfig(fanout="distinct"), **rows) == {"A": 1, "B": 1}


def test_window_is_half_open_and_places_are_excluded(spark):
    out = summarise(
        spark,
        facilities=[facility(i) for i in "ABCDE"],
        new_spills=[
            new_spill("A", "2021-01-01"),
            new_spill("B", "2026-01-01"),
            new_spill("C", "2022-01-01", place=None),
            new_spill("D", "2022-01-01", place="lower LATERAL"),
            new_spill("E", "2022-01-01", kind="Category 3 Spill"),
        ],
    )
    assert out == {"A": 1, "C": 1}


def test_missing_ids_match_each_other(spark):
    t = tables(
        spark,
        facilities=[facility(None, "unknown", fid="F0"), facility("A")],
        new_spills=[new_spill(None, "2022-01-01"), new_spill("", "2022-01-01")],
        annual_reports=[(None, 2021, 5.0, 50.0), (None, 2022, 5.0, 50.0)],
    )
    b = job.base(t, CFG, job.Keeper())
    assert [r.total_spills for r in report.spill_summary(b.weighted).collect()] == [2]
    attrs = by_id(system_attributes(t, CFG), "length")
    assert attrs == {None: 50.0, "A": None}


def test_attributes_of_spilling_and_other_systems(spark):
    t = tables(
        spark,
        facilities=[facility(i) for i in ("both", "near", "zero", "tie", "quiet", "quiet2")]
        + [facility("closed", eligible="No")],
        new_spills=[new_spill(i, "2022-01-01") for i in ("both", "near", "zero")]
        + [new_spill("tie", "2022-06-01", status="New")],
        old_spills=[old_spill(i, "2021-01-01") for i in ("both", "near", "zero")]
        + [old_spill("tie", "2022-09-01", status="Old"), old_spill("quiet2", "2019-01-01")],
        annual_reports=[
            ("both", 2021, None, None),
            ("both", 2020, None, 100.0),
            ("both", 2023, None, 60.0),
            ("near", 2021, None, 90.0),
            ("zero", 2021, None, 0.0),
            ("tie", 2021, 10.0, None),
            ("quiet", 2021, None, 77.0),
            ("quiet", 2023, 5.0, None),
            ("quiet2", 2023, None, 90.0),
        ],
        questionnaire=[
            ("both", None, 70.0),
            ("near", None, 80.0),
            ("zero", None, 0.0),
            ("tie", 99.0, None),
            ("quiet", 50.0, 33.0),
            ("quiet2", 20.0, None),
            ("quiet2", 40.0, 80.0),
        ],
    )
    out = by_id(system_attributes(t, CFG))
    assert "closed" not in out
    # First report with a length in file order, not the newest.
    assert (out["both"]["length_a"], out["both"]["length"]) == (100.0, 70.0)
    assert out["both"]["length_diff_large"] is True
    assert out["near"]["length"] == 90.0
    assert out["zero"]["length"] == 0.0 and out["zero"]["length_diff_large"] is None
    # Equal years: the newer feed wins.
    assert (out["tie"]["status"], out["tie"]["population"]) == ("New", 10.0)
    # Without spills: the newest report counts even if an older one has the
    # length; the questionnaire needs the id in the older feed.
    assert (out["quiet"]["length"], out["quiet"]["population"]) == (None, 5.0)
    assert out["quiet"]["status"] is None
    # First row of the questionnaire that has either value.
    assert (out["quiet2"]["length"], out["quiet2"]["population"]) == (90.0, 20.0)


def rates(spark, window, **rows):
    b = job.base(tables(spark, **rows), CFG, job.Keeper())
    build = job.baseline_rates_5yr if window == 5 else job.baseline_rates_12mo
    return build(b, CFG)


def test_five_years_need_a_span_of_five(spark):
    short = [new_spill("A", f"{y}-05-01") for y in (2021, 2022, 2023, 2024)]
    assert rates(spark, 5, facilities=[facility("A")], new_spills=short).count() == 0
    gap = [new_spill("A", "2021-05-01"), new_spill("A", "2025-05-01"), new_spill("B", "2023-05-01")]
    out = rates(spark, 5, facilities=[facility("A"), facility("B")], new_spills=gap).collect()
    assert sorted((r.wdid, r.year, r.rolling_avg) for r in out) == [("A", 2025, 0.4), ("B", 2025, 0.2)]
    assert all(r.rate is None and r.length_class == "Not Available" for r in out)


def test_twelve_months_use_all_spills_of_the_newer_feed(spark):
    out = rates(
        spark,
        12,
        facilities=[facility("A", eligible="No")],
        new_spills=[
            new_spill("A", "2019-03-01", kind="Category 3 Spill"),
            new_spill("A", "2020-02-01", place="Lateral"),
        ],
        old_spills=[old_spill("A", "2020-06-01", kind="Category 3")],
    ).collect()
    assert [(r.wdid, r.month, r.rolling_avg, r.rate) for r in out] == [
        ("A", dt.date(2020, 2, 1), 2 / 12, None)
    ]


def test_class_without_baseline_has_no_band(spark):
    years = [f"{y}-05-01" for y in range(2021, 2026)]
    banded = spills.banded(
        rates(
            spark,
            5,
            facilities=[facility("A"), facility("B")],
            new_spills=[new_spill(i, y) for i in "AB" for y in years],
            annual_reports=[("A", 2021, None, 200.0), ("B", 2021, None, 10.0)],
            monthly_counts=[month("A", "2026-01-01"), month("B", "2025-06-01", cert=1.0)],
        )
    )
    out = by_id(banded, "in_baseline", "band", "rate")
    # 1 January of the end year still counts for the baseline.
    assert out["A"][:2] == (False, None) and out["A"][2] == pytest.approx(0.5)
    assert out["B"][:2] == (True, "Medium Performing")


def gaps(spark, cfg=CFG, **rows):
    t = tables(spark, **rows)
    known = systems(t["facilities"])
    ids = reporting.uncertified_ids(reporting.month_facts(t["monthly_counts"], cfg), known)
    return {r.wdid for r in ids.collect()}


def test_certificates_are_judged_by_name(spark):
    out = gaps(
        spark,
        facilities=[facility(i) for i in "ABCDEF"],
        monthly_counts=[
            month("A", "2025-03-01", name="shared"),
            month("B", "2025-03-01", name="shared", spills=1.0),
            month("C", "2025-03-01"),
            month("D", "2025-03-01", cert=1.0),
            month("E", "2026-01-01"),
            ("F", None, day("2025-03-01"), 0.0, 0.0),
            month("X", "2025-03-01"),
        ],
    )
    assert out == {"C", "F"}


def test_blank_and_missing_ids_of_orders(spark):
    t = tables(
        spark,
        facilities=[facility(None, fid="F1"), facility("A", fid="F2")],
        enforcement=[order("", fid="F1"), order(None, fid="F1"), order("A", fid="F2"), order("B", fid="F9")],
    )
    orders = enforcement.active_orders(t["enforcement"], t["facilities"], CFG)
    assert sorted(r.wdid or "-" for r in orders.collect()) == ["-", "-", "A"]
    listed = spark.createDataFrame([(None,)], "wdid string")
    under = enforcement.under_enforcement(orders, system_attributes(t, CFG), listed)
    assert {r.wdid for r in under.collect()} == {"", "A"}


def test_order_summary(spark):
    t = tables(
        spark,
        enforcement=[
            order("A", "2022-05-01", "Time Schedule Order", None),
            order("A", "2023-05-01", "Notice of Violation", 5.0),
            order("A", "2021-05-01", "Time Schedule Order", None),
            order("B", "2021-05-01", "Time Schedule Order", None),
        ],
    )
    out = by_id(enforcement.order_summary(t["enforcement"], "wdid", ["row_no"]))
    assert tuple(out["A"])[1:] == (3, "Time Schedule Order; Notice of Violation", day("2023-05-01"), 5.0)
    assert out["B"]["total_assessment_amount"] == 0.0


def test_exemption_needs_class_and_both_limits(spark):
    low = spark.createDataFrame(
        [("m", "Medium", 2.0, 1.0), ("l", "Large", 2.1, 1.0), ("x", "Medium", 2.0, 1.1), ("s", "Small", 2.0, 1.0)],
        "wdid string, length_class_final string, rate_5yr double, rate_12mo double",
    )
    assert {r.wdid for r in spills.exempt(low, ("Medium", "Large"), 2.0, 1.0).collect()} == {"m"}


def fleet():
    """Eight systems of 200 miles; system i has 2i spills in each of five years,
    system 8 only through the questionnaire and without any report."""
    ids = [str(i) for i in range(1, 9)]
    dates = [f"{y}-{m}-15" for y in range(2021, 2026) for m in ("01", "12")]
    return {
        "facilities": [facility(i) for i in ids] + [facility("7", fid="F7b")],
        "new_spills": [new_spill(i, d) for i in ids for d in dates for _ in range(int(i))],
        "old_spills": [old_spill("8", "2021-02-01")],
        "annual_reports": [(i, 2022, 5000.0, 200.0) for i in ids if i != "8"],
        "questionnaire": [("8", 5000.0, 200.0)],
        "monthly_counts": [month("8", "2025-04-01")],
        "enforcement": [order("7"), order("1"), order("1", "2020-01-01")],
    }


def test_whole_report(spark):
    run = screen(tables(spark, **fleet()))
    rows = {(r.wdid, r.facility_id): r for r in run.report.collect()}
    # Cut by systems 1..7 (8 does not report): Q3 = 5.5.
    assert set(rows) == {("6", "F6"), ("7", "F7"), ("7", "F7b"), ("8", "F8")}
    both, seven = rows["8", "F8"], rows["7", "F7"]
    assert both.source == "Reporting Criteria & Low Performance - Spills"
    assert both.reason == REASON_BOTH and both.criteria_met == 2
    assert (both.total_spills, both.length, both.outlier_5yr) == (81, 200.0, None)
    assert seven.reason == REASON_SPILLS and seven.criteria_met == 1
    assert seven.rate_5yr == pytest.approx(7.0) and seven.rate_12mo == pytest.approx(7 / 12)
    assert (seven.month_12mo, seven.region) == (day("2025-12-01"), "7")
    # The order shows in the details, never in the flag.
    assert seven.has_order is False and seven.enforcement_count == 1
    assert seven.low_5yr and seven.low_12mo and seven.outlier_5yr is False
    assert {r.wdid for r in run.under_enforcement.collect()} == {"1"}
    summary = run.summary.collect()[0]
    assert tuple(summary) == (4, 3, 0, 1)
    assert run.reporting_gaps.count() == 1
    run.release()


def test_opt_in_order_flag(spark):
    run = screen(tables(spark, **fleet()), ScreeningConfig(enforcement_flag="all"))
    assert {r.wdid: r.has_order for r in run.report.collect()} == {"6": False, "7": True, "8": False}


def test_result_does_not_depend_on_layout(spark):
    from workload import roles

    folder, results = "/root/testdata/sf0.001", []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "4", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            t = {
                name: df.repartition(int(parts)).orderBy(F.rand(int(parts)))
                for name, df in roles.tables(spark, folder).items()
            }
            run = screen(t, roles.CONFIG)
            results.append(sorted(map(repr, run.report.select(*[
                F.round(c, 9).alias(c) if ty == "double" else F.col(c) for c, ty in run.report.dtypes
            ]).collect())))
            spark.catalog.clearCache()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] and results[0] == results[1] == results[2]
