"""Hand-made staged tables."""

from __future__ import annotations

import datetime as dt

SCHEMAS = {
    "facilities": "wdid string, facility_id string, facility_name string, program_category string, "
    "community_type string, federal_facility string, cs_assessment string",
    "new_spills": "wdid string, spill_date date, spill_type string, location string, status string, "
    "row_no long",
    "old_spills": "wdid string, spill_date date, spill_type string, location string, status string, "
    "row_no long",
    "annual_reports": "wdid string, report_year int, population double, length double, row_no long",
    "questionnaire": "wdid string, population double, length double, row_no long",
    "monthly_counts": "wdid string, system_name string, month date, spill_count double, "
    "no_spill_cert double",
    "enforcement": "facility_id string, wdid string, facility_name string, program_category string, "
    "status string, status_1 string, action_type string, effective_date date, amount double, "
    "row_no long",
}


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def facility(wdid, name=None, eligible="Yes", fid=None):
    return (wdid, fid or f"F{wdid}", name or f"Name {wdid}", "SSO", "Town", "N", eligible)


def new_spill(wdid, when, kind="Category 1 Spill", place="Main", status="Active"):
    return (wdid, day(when), kind, place, status)


def old_spill(wdid, when, kind="Category 1", place="Main", status="Active"):
    return (wdid, day(when), kind, place, status)


def month(wdid, when, spills=0.0, cert=0.0, name=None):
    return (wdid, name or f"Name {wdid}", day(when), spills, cert)


def order(wdid, when="2022-05-01", kind="Notice of Violation", amount=100.0, fid=None):
    return (fid or f"F{wdid}", wdid, f"Name {wdid}", "SSO", "Active", "Active", kind, day(when), amount)


def tables(spark, **rows):
    """Staged tables; ``row_no`` is the place in the list, absent tables are empty."""
    out = {}
    for name, schema in SCHEMAS.items():
        data = rows.get(name, [])
        if schema.endswith("row_no long"):
            data = [(*r, i) for i, r in enumerate(data)]
        out[name] = spark.createDataFrame(data, schema)
    return out


def by_id(df, *cols):
    """{wdid: row or single value}; fails on a repeated id."""
    out = {}
    for r in df.collect():
        assert r["wdid"] not in out, f"repeated id {r['wdid']}"
        out[r["wdid"]] = r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols) if cols else r
    return out
