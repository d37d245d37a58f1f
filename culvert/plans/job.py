"""The whole screening: staged tables in, result frames out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import ScreeningConfig
from culvert.operators.cut import written
from culvert.plans import enforcement, report, reporting, spills
from culvert.plans.attributes import attributes_of, system_facts
from culvert.plans.facts import ID, keyed, spill_rollup, unkeyed


@dataclass
class Screening:
    """Result frames of a run; ``release`` frees what it keeps in executors."""

    attributes: DataFrame
    rates_5yr: DataFrame
    rates_12mo: DataFrame
    low_both: DataFrame
    reporting_gaps: DataFrame
    listed: DataFrame
    active_orders: DataFrame
    under_enforcement: DataFrame
    report: DataFrame
    summary: DataFrame
    stages: dict[str, DataFrame]
    kept: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


class Keeper:
    """Persists frames that several results read; spills to disk when large.
    A lost executor only costs the recomputation of its partitions."""

    def __init__(self) -> None:
        self.kept: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(out)
        return out


@dataclass
class Base:
    """Frames both criteria start from, laid out by asset id."""

    facts: DataFrame
    weighted: DataFrame
    months: DataFrame
    silent: DataFrame
    stages: dict[str, DataFrame]


def base(
    tables: Mapping[str, DataFrame],
    cfg: ScreeningConfig,
    keep: Callable[[DataFrame], DataFrame],
    months: DataFrame | None = None,
) -> Base:
    """``months`` may bring a kept ``reporting.month_facts`` that others read too."""
    rollup = keep(spill_rollup(tables["new_spills"], tables["old_spills"], cfg))
    facts = written(system_facts(tables, rollup, cfg), "facts")
    if months is None:
        months = reporting.month_facts(tables["monthly_counts"], cfg)
    return Base(
        facts,
        spills.weighted_rollup(rollup, facts),
        months,
        reporting.silent_ids(months, facts),
        spills.stage_counts(rollup, facts),
    )


def baseline_rates_5yr(b: Base, cfg: ScreeningConfig) -> DataFrame:
    """5-year rates of all assets with a counted spill, baseline marked."""
    return spills.in_baseline(spills.rates_5yr(spills.yearly_counts(b.weighted), cfg), b.silent)


def baseline_rates_12mo(b: Base, cfg: ScreeningConfig) -> DataFrame:
    """12-month rates of all assets of the newer feed with a full span."""
    return spills.in_baseline(spills.rates_12mo(spills.month_counts(b.weighted), cfg), b.silent)


def bands(
    b: Base,
    cfg: ScreeningConfig,
    keep: Callable[[DataFrame], DataFrame],
    outliers: bool = True,
) -> DataFrame:
    """Banded rates of both windows (see ``spills.of_window``), stored."""
    rates = spills.both_windows(
        spills.rates_5yr(spills.yearly_counts(b.weighted), cfg),
        spills.rates_12mo(spills.month_counts(b.weighted), cfg),
    )
    rates = keep(spills.in_baseline(rates, b.silent))
    if outliers:
        return written(spills.banded_with_outliers(rates, cfg), "bands")
    return written(spills.banded(rates, "rate_group"), "bands")


def screen(tables: Mapping[str, DataFrame], cfg: ScreeningConfig = ScreeningConfig()) -> Screening:
    """Runs the screening on staged tables (see ``sources.staging.STAGED``).

    Frames are lazy, except that some stages are stored in the shared
    checkpoint folder and the outlier test runs a few jobs.
    """
    keep = Keeper()
    facilities = tables["facilities"]
    b = base(tables, cfg, keep, keep(reporting.month_facts(tables["monthly_counts"], cfg)))
    attributes = attributes_of(b.facts)

    # Stored, not cached: a cached frame keeps its whole logical plan, and a frame
    # as often read as this one would make the final plan explode.
    rows = bands(b, cfg, keep)
    bands5 = spills.of_window(rows, spills.FIVE_YEARS)
    bands12 = spills.of_window(rows, spills.TWELVE_MONTHS)
    low = spills.not_exempt(spills.low_both(bands5, bands12), cfg)

    no_certificate = reporting.uncertified_ids(b.months, b.facts)
    no_report = b.facts.where("eligible AND NOT has_report").select(ID)
    eligible = reporting.eligible_rows(facilities)
    gaps = eligible.join(no_report, ID, "left_semi").join(no_certificate, ID, "left_semi")
    orders = keep(enforcement.active_orders(tables["enforcement"], facilities, cfg))

    records = report.asset_records(b.facts, rows, no_certificate, cfg)
    listed = report.listed_assets(facilities, records)
    wide = report.assemble(
        listed,
        facilities,
        records,
        enforcement.order_summary(keyed(orders), ID, cfg.order_sequence),
        report.spill_summary(b.weighted),
        # Orders only count here for unlisted assets, and the report lists no such
        # asset: by default the flag is FALSE throughout.
        keyed(orders).select(ID).distinct() if cfg.enforcement_flag == "all" else None,
    )
    final = unkeyed(wide)
    return Screening(
        attributes=unkeyed(attributes),
        rates_5yr=unkeyed(bands5),
        rates_12mo=unkeyed(bands12),
        low_both=unkeyed(spills.described(low, facilities)),
        reporting_gaps=unkeyed(reporting.with_attributes(gaps, b.facts)),
        listed=unkeyed(listed),
        active_orders=orders,
        under_enforcement=unkeyed(
            enforcement.under_enforcement(orders, attributes, unkeyed(listed))
        ),
        report=final,
        summary=report.summary(final),
        stages=b.stages | {"silent": unkeyed(b.silent), "uncertified": unkeyed(no_certificate), "unreported": unkeyed(no_report)},
        kept=keep.kept,
    )


def system_report(
    tables: Mapping[str, DataFrame], cfg: ScreeningConfig = ScreeningConfig()
) -> DataFrame:
    """The final report of a run."""
    return screen(tables, cfg).report
