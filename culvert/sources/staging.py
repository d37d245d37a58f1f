"""Raw feeds (text columns) to staged tables (typed, snake_case).

A staged column is a raw column, or an expression over raw columns. A raw
column that a feed lacks is NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.functions import clean_numeric, free_date, lenient_date, month_label, plain_numeric
from culvert.sources.delimited import read_delimited

Raw = Callable[[str], Column]


@dataclass(frozen=True)
class Feed:
    """File stem of a feed, its NA tokens and its staged columns."""

    stem: str
    columns: Mapping[str, Callable[[Raw], Column]]
    tokens: tuple[str, ...] = ("NA",)
    upper: bool = False


def _text(name: str) -> Callable[[Raw], Column]:
    return lambda raw: raw(name)


def _number(name: str) -> Callable[[Raw], Column]:
    return lambda raw: plain_numeric(raw(name))


def _clean(name: str) -> Callable[[Raw], Column]:
    return lambda raw: clean_numeric(raw(name))


def _clean_sum(a: str, b: str) -> Callable[[Raw], Column]:
    return lambda raw: clean_numeric(raw(a)) + clean_numeric(raw(b))


def _day(name: str, fmt: str) -> Callable[[Raw], Column]:
    return lambda raw: lenient_date(raw(name), fmt)


# File stems and raw column names of the seven feeds.
STAGED: dict[str, Feed] = {
    "facilities": Feed(
        "facilities",
        {
            "wdid": _text("WDID"),
            "facility_id": _text("FACILITY.ID"),
            "facility_name": _text("FACILITY.NAME"),
            "program_category": _text("PROGRAM.CATEGORY"),
            "community_type": _text("COMMUNITY.TYPE"),
            "federal_facility": _text("FEDERAL.FACILITY"),
            "cs_assessment": _text("CS.ASSESSMENT"),
        },
        tokens=("", "NA", "#N/A"),
    ),
    "new_spills": Feed(
        "Cat1_2_3",
        {
            "wdid": _text("WDID"),
            "spill_date": _day("ESTIMATED_SPILL_START_DATE_AND_TIME", "%m/%d/%Y %H:%M"),
            "spill_type": _text("SPILL_TYPE"),
            "location": _text("APPEARANCE_POINTS"),
            "status": _text("STATUS"),
        },
    ),
    "old_spills": Feed(
        "SSO",
        {
            "wdid": _text("WDID"),
            "spill_date": _day("START.DT", "%m/%d/%Y"),
            "spill_type": _text("SPILL.TYPE"),
            "location": _text("WHERE.FAILURE.OCCUR"),
            "status": _text("STATUS"),
        },
    ),
    "annual_reports": Feed(
        "AnnualReports",
        {
            "wdid": _text("WDID"),
            "report_year": lambda raw: plain_numeric(raw("ANNUAL_REPORT_YEAR")).try_cast("int"),
            "population": _clean("POP_SERVED"),
            "length": _clean_sum("MILES_FORCED_MAINS", "MILES_GRAVITY_SEWERS"),
            "updated": lambda raw: free_date(raw("LAST_UPDATED_ON")),
        },
    ),
    "questionnaire": Feed(
        "Questionnaire",
        {
            "wdid": _text("WDID"),
            "population": _clean("SSOQ.POPULATION.SERVED"),
            "length": _clean_sum("SSOQ_MILES_OF_FORCE_MAIN", "SSOQ_MILES_OF_GRAVITY_SEWER"),
        },
        upper=True,
    ),
    "monthly_counts": Feed(
        "neworder_no_spills",
        {
            "wdid": _text("WDID"),
            "system_name": _text("SEWER_SYSTEM_NAME"),
            "month": lambda raw: month_label(raw("MONTH_YEAR")),
            "spill_count": _number("CAT_1_2_3_SPILL_COUNT"),
            "no_spill_cert": _number("NO_SPILLS..0.No.1.Yes."),
        },
    ),
    "enforcement": Feed(
        "enforcement",
        {
            "facility_id": _text("FACILITY.ID"),
            "wdid": _text("WDID"),
            "facility_name": _text("FACILITY.NAME"),
            "program_category": _text("PROGRAM.CATEGORY"),
            "status": _text("STATUS"),
            "status_1": _text("STATUS.1"),
            "action_type": _text("ENFORCEMENT.ACTION.TYPE"),
            "effective_date": _day("EFFECTIVE.DATE.1", "%m/%d/%Y"),
            "amount": _number("TOTAL.ASSESSMENT.AMOUNT"),
        },
    ),
}


def stage(raw: DataFrame, columns: Mapping[str, Callable[[Raw], Column]]) -> DataFrame:
    """Typed table from a raw one; ``row_no`` is carried along when present."""
    present = set(raw.columns)

    def column(name: str) -> Column:
        return F.col(f"`{name}`") if name in present else F.lit(None).cast("string")

    carried = ["row_no"] if "row_no" in present else []
    return raw.select(*[f(column).alias(name) for name, f in columns.items()], *carried)


def from_folder(
    spark: SparkSession,
    folder: str,
    suffix: str = ".csv",
    sep: str = ",",
    mangle: bool = False,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """All staged tables from a folder of feeds, one file or folder per feed."""
    tables = {}
    for name, feed in STAGED.items():
        local = name in ("facilities", "enforcement")
        raw = read_delimited(
            spark,
            f"{folder}/{feed.stem}{'.csv' if local else suffix}",
            sep="," if local else sep,
            tokens=feed.tokens,
            upper=feed.upper,
            mangle=mangle or local,
            multiline=multiline,
        )
        tables[name] = stage(raw, feed.columns)
    return tables
