"""Spill criterion: rates over five years and twelve months, bands, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import LOW_PERFORMING, PERFORMANCE_CATEGORY, ScreeningConfig
from culvert.functions import band as band_of
from culvert.functions import region, scaled_rate
from culvert.operators.outliers import gesd
from culvert.operators.panels import densify_global, rolling_mean, trailing_mean_latest
from culvert.operators.picks import first_row
from culvert.operators.quantiles import quartiles
from culvert.plans.facts import ID, NEW, NO_ID, OLD, keyed

PANEL_KEYS = [ID, "length_class", "length"]
FIVE_YEARS, TWELVE_MONTHS = "5yr", "12mo"


def weighted_rollup(rollup: DataFrame, facts: DataFrame) -> DataFrame:
    """Roll-up rows of known assets with their attributes and the number of
    times each counts (``n``): reports or answers of an asset multiply its
    spills, as a join of the raw tables would."""
    weight = F.when(F.col("feed") == NEW, F.col("new_weight")).otherwise(F.col("old_weight"))
    known = rollup.join(facts, ID)
    # Assets without attributes have no size class in any panel.
    cls = F.when(F.col("has_attributes"), F.col("length_class"))
    size = F.when(F.col("has_attributes"), F.col("length"))
    return known.select(
        ID,
        "feed",
        "month",
        "spill_type",
        "in_scope",
        (F.col("rows") * weight).alias("n"),
        cls.alias("length_class"),
        size.alias("length"),
    )


def stage_counts(rollup: DataFrame, facts: DataFrame) -> dict[str, DataFrame]:
    """Spill rows per asset (``n``) as read and as cleaned, from the folded counts: no
    feed is read again."""
    known = rollup.where("in_scope").join(facts.select(ID), ID, "left_semi")
    out = {}
    for name, feed in (("new_spills", NEW), ("old_spills", OLD)):
        for stage, rows in ((f"raw_{name}", rollup), (f"clean_{name}", known)):
            out[stage] = rows.where(F.col("feed") == feed).select(ID, F.col("rows").alias("n"))
    return out


def yearly_counts(weighted: DataFrame) -> DataFrame:
    """Counted spills of both feeds per asset and year."""
    return (
        weighted.where("in_scope")
        .groupBy(*PANEL_KEYS, F.year("month").alias("year"))
        .agg(F.sum("n").alias("spill_count"))
    )


def month_counts(weighted: DataFrame) -> DataFrame:
    """All dated spills of the newer feed per asset and month: every category
    and place, also outside the analysis window."""
    return (
        weighted.where((F.col("feed") == NEW) & F.col("month").isNotNull())
        .groupBy(*PANEL_KEYS, "month")
        .agg(F.sum("n").alias("spill_count"))
    )


def rates_5yr(counts: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Mean yearly count over each full window of years, and its scaled rate.
    Only assets with a counted spill are in the panel."""
    dense = densify_global(counts, PANEL_KEYS, "year", "spill_count")
    means = rolling_mean(
        dense, [ID, "length_class"], "year", "spill_count", cfg.rolling_years, "rolling_avg"
    )
    return means.drop("spill_count").withColumn(
        "rate", scaled_rate(F.col("rolling_avg"), F.col("length"))
    )


def rates_12mo(counts: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Mean monthly count over the twelve months that end at an asset's own last
    spill month, and its scaled rate."""
    means = trailing_mean_latest(
        counts, PANEL_KEYS, "month", "spill_count", cfg.rolling_months, "rolling_avg"
    )
    return means.withColumn("rate", scaled_rate(F.col("rolling_avg"), F.col("length")))


def in_baseline(rates: DataFrame, silent_ids: DataFrame) -> DataFrame:
    """Marks assets that take part in quartiles and outlier tests."""
    out = silent_ids.select(ID).withColumn("_silent", F.lit(True))
    return rates.join(out, ID, "left").withColumn("in_baseline", F.col("_silent").isNull()).drop(
        "_silent"
    )


def band(df: DataFrame, q: DataFrame, cls: str = "length_class", x: str = "rate") -> DataFrame:
    """Band per row from the quartiles of its class (one row per class)."""
    joined = df.join(F.broadcast(q), cls, "left")
    return joined.withColumn("band", band_of(F.col(x), F.col("q1"), F.col("q3"))).drop("q1", "q3")


def banded(rates: DataFrame, cls: str = "length_class") -> DataFrame:
    """Bands for all assets, cut by the quartiles of the baseline assets."""
    return band(rates, quartiles(rates.where("in_baseline"), cls, "rate"), cls)


def both_windows(rates5: DataFrame, rates12: DataFrame) -> DataFrame:
    """Rates of both windows as one table, so that quartiles and outlier test
    of all (window, class) groups take one pass each."""
    common = [*PANEL_KEYS, "rolling_avg", "rate"]
    five = rates5.select(*common, F.lit(FIVE_YEARS).alias("window"), F.col("year").alias("period"))
    month = F.year("month") * 100 + F.month("month")
    twelve = rates12.select(
        *common, F.lit(TWELVE_MONTHS).alias("window"), month.alias("period"), "month"
    )
    both = five.unionByName(twelve, allowMissingColumns=True)
    return both.withColumn("rate_group", F.concat_ws("|", "window", "length_class"))


def banded_with_outliers(rates: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Bands of :func:`both_windows` plus the informational outlier mark, which
    is NULL outside the baseline."""
    tie = [ID, "period"]
    marks = gesd(rates.where("in_baseline"), "rate_group", "rate", tie, cfg.outlier_alpha)
    return banded(rates, "rate_group").join(marks, ["rate_group", *tie], "left")


def of_window(bands: DataFrame, window: str) -> DataFrame:
    """Bands of one window, with ``year`` or ``month`` as the period."""
    rows = bands.where(F.col("window") == window).drop("window", "rate_group")
    if window == FIVE_YEARS:
        return rows.drop("month").withColumnRenamed("period", "year")
    return rows.drop("period")


def low_rows(bands: DataFrame) -> DataFrame:
    """Rows in the low band."""
    return bands.where(F.col("band") == LOW_PERFORMING)


def low_both(bands5: DataFrame, bands12: DataFrame) -> DataFrame:
    """Assets low in both windows, one row each; of several low years the first."""
    low5 = first_row(low_rows(bands5), [ID], ["year"])
    left = low5.select(
        ID,
        F.col("rate").alias("rate_5yr"),
        F.col("band").alias("band_5yr"),
        F.col("length_class").alias("length_class_5yr"),
    )
    right = low_rows(bands12).select(
        ID,
        F.col("rate").alias("rate_12mo"),
        F.col("band").alias("band_12mo"),
        F.col("length_class").alias("length_class_12mo"),
    )
    c5, c12 = F.col("length_class_5yr"), F.col("length_class_12mo")
    final = F.when(c5 != c12, c12).when(c5 == c12, c5)
    return left.join(right, ID).withColumn("length_class_final", final)


def exempt(low: DataFrame, classes, limit_5yr: float, limit_12mo: float) -> DataFrame:
    """Low assets of the given classes that keep both absolute limits."""
    return low.where(
        F.col("length_class_final").isin(*classes)
        & (F.col("rate_5yr") <= limit_5yr)
        & (F.col("rate_12mo") <= limit_12mo)
    )


def described(low: DataFrame, facilities: DataFrame) -> DataFrame:
    """The low list with region, facility name and criterion, one row per name."""
    names = keyed(facilities).select(ID, "facility_name").distinct()
    rest = [c for c in low.columns if c not in (ID, "length_class_final")]
    return (
        low.join(names, ID, "left")
        .withColumn("region", region(F.nullif(F.col(ID), F.lit(NO_ID))))
        .withColumn("performance_category", F.lit(PERFORMANCE_CATEGORY))
        .select("region", ID, "facility_name", "performance_category", "length_class_final", *rest)
    )


def not_exempt(low: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Low assets that stay listed."""
    out = exempt(low, cfg.limit_classes, cfg.limit_5yr, cfg.limit_12mo)
    return low.join(out.select(ID), ID, "left_anti")
