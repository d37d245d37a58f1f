"""The screening job, composed from operators.

Shape of the plans: every feed is folded to counts by map-side aggregation
before anything is shuffled, then laid out by asset id once. Attributes, panels
and windows work on that layout; the report joins one record per asset. Only
thresholds per size class and other small sides are exchanged in between.
"""

from culvert.plans.attributes import system_attributes
from culvert.plans.enforcement import active_orders, order_summary, under_enforcement
from culvert.plans.job import Screening, screen, system_report
from culvert.plans.report import RESULT_HEADERS, summary
from culvert.plans.reporting import both_gaps, silent

__all__ = [
    "RESULT_HEADERS",
    "Screening",
    "active_orders",
    "both_gaps",
    "order_summary",
    "screen",
    "silent",
    "summary",
    "system_attributes",
    "system_report",
    "under_enforcement",
]
