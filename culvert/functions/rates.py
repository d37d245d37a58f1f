"""Size classes, two-source reconciliation, scaled rates, bands and reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from culvert import config as k


def classify(c: Column, cuts) -> Column:
    """Label of the first cut that holds; NULL input is "Not Available"."""
    out = F.when(c.isNull(), F.lit(k.NOT_AVAILABLE))
    for label, op, bound in cuts:
        if op is None:
            return out.otherwise(F.lit(label))
        out = out.when(c > bound if op == ">" else c >= bound, F.lit(label))
    return out


def rel_diff(a: Column, b: Column) -> Column:
    """|a-b| / max(a, b) when both are there, else NULL (also for 0 and 0)."""
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.try_divide(F.abs(a - b), F.greatest(a, b)))


def reconcile(a: Column, b: Column, limit: float = 0.20) -> Column:
    """One value from two sources: the only one, the smaller when they differ
    by more than ``limit``, else the first."""
    return F.when(a.isNull(), b).when(rel_diff(a, b) > limit, F.least(a, b)).otherwise(a)


def reconcile_min(a: Column, b: Column) -> Column:
    """The smaller of two sources, or the only one (``least`` skips NULL)."""
    return F.least(a, b)


def scaled_rate(avg: Column, length: Column, bases=k.SCALE_BASES) -> Column:
    """Rate per scale base; NULL for a missing or zero length."""
    scale = F.when(length.isNull(), F.lit(None).cast("double"))
    for upper, base in bases:
        scale = scale.otherwise(F.lit(base)) if upper is None else scale.when(
            length < upper, F.lit(base)
        )
    return F.when(length != 0, F.try_divide(avg, length / scale))


def band(rate: Column, q1: Column, q3: Column) -> Column:
    """Performance band; a rate on a quartile is in the middle band."""
    return (
        F.when(rate < q1, F.lit(k.HIGH_PERFORMING))
        .when((rate >= q1) & (rate <= q3), F.lit(k.MEDIUM_PERFORMING))
        .when(rate > q3, F.lit(k.LOW_PERFORMING))
    )


def reason(low_both: Column, no_certificate: Column, no_report: Column) -> Column:
    """Why an asset is listed, from its three flags."""
    reporting = no_certificate & no_report
    return (
        F.when(low_both & reporting, F.lit(k.REASON_BOTH))
        .when(low_both, F.lit(k.REASON_SPILLS))
        .when(reporting, F.lit(k.REASON_REPORTING))
        .otherwise(F.lit(k.REASON_OTHER))
    )


def criteria_met(low_both: Column, no_certificate: Column, no_report: Column) -> Column:
    """How many of the two criteria hold."""
    return low_both.cast("int") + (no_certificate & no_report).cast("int")
