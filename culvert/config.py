"""Settings of a screening run, passed to every plan (no globals)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Labels and cut points that the results must carry.
LARGE, MEDIUM, SMALL, MICRO = "Large", "Medium", "Small", "Micro"
NOT_AVAILABLE = "Not Available"
HIGH_PERFORMING = "High Performing"
MEDIUM_PERFORMING = "Medium Performing"
LOW_PERFORMING = "Low Performing"

# (label, comparison, bound), tested in order; the last one takes the rest.
POPULATION_CUTS = (
    (LARGE, ">", 100000.0),
    (MEDIUM, ">", 10000.0),
    (SMALL, ">=", 2500.0),
    (MICRO, None, None),
)
LENGTH_CUTS = (
    (LARGE, ">=", 500.0),
    (MEDIUM, ">=", 100.0),
    (SMALL, ">=", 25.0),
    (MICRO, None, None),
)
# (upper length bound, scale base in miles)
SCALE_BASES = ((5.0, 5.0), (25.0, 25.0), (None, 100.0))
SIZE_CLASS_TEXT = (
    (LARGE, ">= 500 miles"),
    (MEDIUM, "100 - 499 miles"),
    (SMALL, "25 - 99 miles"),
    (MICRO, "< 25 miles"),
    (NOT_AVAILABLE, "NA"),
)
ORDER_TYPES = (
    "Admin Civil Liability",
    "Cease and Desist Order",
    "Clean-up and Abatement Order",
    "Time Schedule Order",
    "Notice of Violation",
)
SOURCE_REPORTING = "Reporting Criteria"
SOURCE_SPILLS = "Low Performance - Spills"
REASON_BOTH = "Low Performance (System Length, 5yr & 12mo) & Reporting Criteria"
REASON_SPILLS = "Low Performance - System Length (5yr & 12mo)"
REASON_REPORTING = "Reporting Criteria"
REASON_OTHER = "Other"
FLAG_NO_CERTIFICATE = "No spills reported"
FLAG_NO_REPORT = "No annual report"
PERFORMANCE_CATEGORY = "Length"


def _year_before(day: dt.date) -> dt.date:
    # 29 February has no counterpart in the year before; take the 28th.
    if (day.month, day.day) == (2, 29):
        return dt.date(day.year - 1, 2, 28)
    return day.replace(year=day.year - 1)


@dataclass(frozen=True)
class ScreeningConfig:
    """Windows, accepted values and limits. The defaults are the published run.

    ``analysis_*`` is half open. ``reporting_*`` (certificates, half open) and
    ``baseline_*`` (reporters that set the quartiles, closed) default to the
    last year of the analysis window.
    """

    analysis_start: dt.date = dt.date(2021, 1, 1)
    analysis_end: dt.date = dt.date(2026, 1, 1)
    reporting_start: dt.date | None = None
    reporting_end: dt.date | None = None
    baseline_start: dt.date | None = None
    baseline_end: dt.date | None = None

    new_types: tuple[str, ...] = ("Category 1 Spill", "Category 2 Spill")
    old_types: tuple[str, ...] = ("Category 1", "Category 2")
    excluded_pattern: str = "Lateral"

    rolling_years: int = 5
    rolling_months: int = 12
    discrepancy_limit: float = 0.20
    limit_5yr: float = 2.0
    limit_12mo: float = 1.0
    limit_classes: tuple[str, ...] = (MEDIUM, LARGE)

    order_program: str = "SSO"
    order_status: str = "Active"
    order_types: tuple[str, ...] = ORDER_TYPES
    # Row order of enforcement orders, for "first appearance" of a type.
    order_sequence: tuple[str, ...] = ("row_no",)

    outlier_alpha: float = 0.05
    # Opt-in departures from the default rules.
    fanout: str = "reference"  # or "distinct": count every spill once
    enforcement_flag: str = "unlisted"  # or "all": test against all active orders

    def window(self, kind: str) -> tuple[dt.date, dt.date]:
        """Bounds of the ``analysis``, ``reporting`` or ``baseline`` window."""
        if kind == "analysis":
            return self.analysis_start, self.analysis_end
        start = getattr(self, f"{kind}_start")
        end = getattr(self, f"{kind}_end")
        return start or _year_before(self.analysis_end), end or self.analysis_end
