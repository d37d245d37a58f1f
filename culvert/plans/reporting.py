"""Reporting criterion: no certificates and no annual report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import FLAG_NO_CERTIFICATE, FLAG_NO_REPORT, ScreeningConfig
from culvert.functions import region
from culvert.operators.joins import inner_join, keep_in, keep_not_in
from culvert.plans.facts import ID, NO_ID, keyed

FACILITY_KEYS = [ID, "facility_name", "program_category", "cs_assessment"]


def silent(
    df: DataFrame, by: str, start: dt.date, end: dt.date, closed: bool
) -> DataFrame:
    """Values of ``by`` with rows in the window but neither a spill nor a
    no-spill certificate. Group totals, so no group is ever gathered."""
    month = F.col("month")
    until = month <= F.lit(end) if closed else month < F.lit(end)
    totals = df.where((month >= F.lit(start)) & until).groupBy(by).agg(
        F.coalesce(F.sum("spill_count"), F.lit(0)).alias("spills"),
        F.coalesce(F.sum("no_spill_cert"), F.lit(0)).alias("certs"),
    )
    return totals.where("spills < 1 AND certs < 1").select(by)


def month_facts(monthly: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Rows, spills and certificates per (id, name) in the baseline window
    (``b_``, closed) and in the reporting window (``r_``, half open), from one
    scan of the months they cover."""
    month = F.col("month")
    b_start, b_end = cfg.window("baseline")
    r_start, r_end = cfg.window("reporting")
    windows = {
        "b": (month >= F.lit(b_start)) & (month <= F.lit(b_end)),
        "r": (month >= F.lit(r_start)) & (month < F.lit(r_end)),
    }
    first, last = F.lit(min(b_start, r_start)), F.lit(max(b_end, r_end))
    covered = keyed(monthly).where((month >= first) & (month <= last))
    sums = []
    for prefix, inside in windows.items():
        sums += [
            F.count_if(inside).alias(f"{prefix}_rows"),
            F.sum(F.when(inside, F.col("spill_count"))).alias(f"{prefix}_spills"),
            F.sum(F.when(inside, F.col("no_spill_cert"))).alias(f"{prefix}_certs"),
        ]
    return covered.groupBy(ID, "system_name").agg(*sums)


def _quiet(months: DataFrame, by: str, prefix: str) -> DataFrame:
    """Values of ``by`` with rows in a window but no spill and no certificate."""
    totals = months.where(F.col(f"{prefix}_rows") > 0).groupBy(by).agg(
        F.coalesce(F.sum(f"{prefix}_spills"), F.lit(0)).alias("spills"),
        F.coalesce(F.sum(f"{prefix}_certs"), F.lit(0)).alias("certs"),
    )
    return totals.where("spills < 1 AND certs < 1").select(by)


def silent_ids(months: DataFrame, systems: DataFrame) -> DataFrame:
    """Known ids to leave out of the baseline (judged by id)."""
    return _quiet(months, ID, "b").join(systems.select(ID), ID, "left_semi")


def uncertified_ids(months: DataFrame, systems: DataFrame) -> DataFrame:
    """Known ids under a silent *name*.

    A known system of the same name that reports clears all ids of that name.
    """
    known = months.where("r_rows > 0").join(systems.select(ID), ID, "left_semi")
    return keep_in(known, _quiet(known, "system_name", "r"), "system_name").select(ID).distinct()


def eligible_rows(facilities: DataFrame) -> DataFrame:
    """Distinct eligible facility rows."""
    return keyed(facilities).where(F.col("cs_assessment") == "Yes").select(*FACILITY_KEYS).distinct()


def filed_by(reports: DataFrame, end: dt.date) -> DataFrame:
    """Reports last updated by ``end`` or at an unknown date. The criteria do
    not use it: any report counts, whatever its date."""
    updated = F.col("updated")
    return reports.where(updated.isNull() | (updated <= F.lit(end)))


def missing_report(facilities: DataFrame, reports: DataFrame) -> DataFrame:
    """Eligible facility rows whose id never filed a report, whatever the date."""
    missing = keep_not_in(eligible_rows(facilities), keyed(reports), ID)
    return missing.withColumn("flag_reason", F.lit(FLAG_NO_REPORT))


def missing_certificate(facilities: DataFrame, ids: DataFrame) -> DataFrame:
    """Eligible facility rows of :func:`uncertified_ids`."""
    missing = eligible_rows(facilities).join(ids, ID, "left_semi")
    return missing.withColumn("flag_reason", F.lit(FLAG_NO_CERTIFICATE))


def with_attributes(gaps: DataFrame, facts: DataFrame) -> DataFrame:
    """The reporting list: region, facility, size classes, population and length."""
    sizes = ("population_class", "length_class", "population", "length")
    known = facts.where("has_attributes").select(ID, *sizes)
    return (
        gaps.join(known, ID, "left")
        .withColumn("region", region(F.nullif(F.col(ID), F.lit(NO_ID))))
        .select("region", *FACILITY_KEYS, *sizes)
    )


def both_gaps(a: DataFrame, b: DataFrame, on: list[str] = FACILITY_KEYS) -> DataFrame:
    """Facility rows with both gaps; keys may be NULL."""
    return inner_join(a.select(*on), b.select(*on), on).distinct()
