"""Column expressions. All of them stay on the JVM; none is a Python UDF."""

from culvert.functions.rates import (
    band,
    classify,
    criteria_met,
    reason,
    reconcile,
    reconcile_min,
    rel_diff,
    scaled_rate,
)
from culvert.functions.text import (
    clean_numeric,
    contains_any_case,
    free_date,
    lenient_date,
    month_label,
    not_matching,
    null_tokens,
    plain_numeric,
    region,
)

__all__ = [
    "band",
    "classify",
    "clean_numeric",
    "contains_any_case",
    "criteria_met",
    "free_date",
    "lenient_date",
    "month_label",
    "not_matching",
    "null_tokens",
    "plain_numeric",
    "reason",
    "reconcile",
    "reconcile_min",
    "region",
    "rel_diff",
    "scaled_rate",
]
