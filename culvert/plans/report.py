"""Combined list, final report and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import LOW_PERFORMING, SOURCE_REPORTING, SOURCE_SPILLS, ScreeningConfig
from culvert.functions import criteria_met, reason, region
from culvert.operators.layout import layout
from culvert.operators.picks import label_sources
from culvert.plans.attributes import ATTRIBUTES
from culvert.plans.facts import ID, NO_ID, keyed
from culvert.plans.spills import FIVE_YEARS, TWELVE_MONTHS

# Order and file headers of the result columns.
RESULT_HEADERS = {
    "region": "REGION",
    "wdid": "WDID",
    "facility_name": "FACILITY.NAME",
    "facility_id": "FACILITY.ID",
    "program_category": "PROGRAM.CATEGORY",
    "source": "Source",
    "reason": "Detailed_Inadequacy_Reason",
    "criteria_met": "Number_of_Criteria_Met",
    "population": "POP_SERVED_COMBINED",
    "population_class": "Size_Category_Pop_Served",
    "length": "TOTAL_SYS_LENGTH_COMBINED",
    "length_class": "Size_Category_Length",
    "band_5yr": "performance_band_5yr_length",
    "rate_5yr": "rolling_avg_5yr_scaled_length",
    "band_12mo": "performance_band_12mo_length",
    "rate_12mo": "rolling_avg_12mo_scaled_length",
    "total_spills": "Total_Spills_5yr",
    "cat1_spills": "Cat1_Spills_5yr",
    "cat2_spills": "Cat2_Spills_5yr",
    "last_spill_year": "Most_Recent_Spill_Year",
    "low_5yr": "Low_Perf_Length_5yr",
    "low_12mo": "Low_Perf_Length_12mo",
    "low_both": "Low_Perf_Both_Length",
    "no_certificate": "Missing_No_Spill_Cert",
    "no_report": "Missing_Annual_Report",
    "has_order": "Has_Enforcement_Order",
    "enforcement_count": "Enforcement_Count",
    "enforcement_types": "Enforcement_Types",
    "latest_enforcement_date": "Latest_Enforcement_Date",
    "total_assessment_amount": "Total_Assessment_Amount",
    "community_type": "COMMUNITY.TYPE",
    "federal_facility": "FEDERAL.FACILITY",
    "length_a": "Total_System_Length_AR",
    "length_b": "Total_System_Length_SSOQ",
    "length_diff": "TOTAL_SYS_LENGTH_DIFF_PCT",
    "length_diff_large": "TOTAL_SYS_LENGTH_FLAG_LARGE_DIFF",
    "avg_5yr": "rolling_avg_5yr_length",
    "outlier_5yr": "is_outlier_5yr_length",
    "month_12mo": "spill_year_month_length",
    "avg_12mo": "rolling_avg_12mo_length",
    "outlier_12mo": "is_outlier_12mo_length",
}


def spill_summary(weighted: DataFrame, key: str = ID) -> DataFrame:
    """Counted spills per asset: total, by category, last year."""
    n = F.col("n")

    def of(category: str):
        return F.coalesce(F.sum(F.when(F.col("spill_type").contains(category), n)), F.lit(0))

    return weighted.where("in_scope").groupBy(key).agg(
        F.sum(n).alias("total_spills"),
        of("Category 1").alias("cat1_spills"),
        of("Category 2").alias("cat2_spills"),
        F.max(F.year("month")).alias("last_spill_year"),
    )


def combine(low: DataFrame, gaps: DataFrame, facilities: DataFrame, systems: DataFrame) -> DataFrame:
    """Eligible assets on either list, with the text of their sources."""
    names = keyed(facilities).select(ID, "facility_name")
    frames = [
        (SOURCE_REPORTING, gaps.select(ID, "facility_name")),
        (SOURCE_SPILLS, low.select(ID).join(names, ID, "left")),
    ]
    labelled = label_sources(frames, [ID, "facility_name"])
    return labelled.join(systems.where("eligible").select(ID), ID, "left_semi").select(
        region(F.nullif(F.col(ID), F.lit(NO_ID))).alias("region"), ID, "facility_name", "source"
    )


def fold_bands(bands: DataFrame) -> DataFrame:
    """All that the report takes from the bands of both windows, one row per asset:
    the last full five years, the twelve months, and the first low row of each."""
    five, twelve = F.col("window") == FIVE_YEARS, F.col("window") == TWELVE_MONTHS
    low = F.col("band") == LOW_PERFORMING
    both = ("rolling_avg", "rate", "band", "is_outlier")
    return bands.groupBy(ID).agg(
        F.max_by(F.struct(*both), F.when(five, F.col("period"))).alias("_five"),
        F.max_by(F.struct("month", *both), F.when(twelve, F.col("period"))).alias("_twelve"),
        F.min_by(F.struct("rate", "length_class"), F.when(five & low, F.col("period"))).alias("_low5"),
        F.min_by(F.struct("rate", "length_class"), F.when(twelve & low, F.col("period"))).alias("_low12"),
    )


def asset_records(
    facts: DataFrame, bands: DataFrame, no_certificate: DataFrame, cfg: ScreeningConfig
) -> DataFrame:
    """One row per known asset: its attributes, bands and flags. Reads each input once."""
    marked = no_certificate.select(ID).withColumn("_uncertified", F.lit(True))
    joined = facts.join(fold_bands(bands), ID, "left").join(marked, ID, "left")
    low5, low12 = F.col("_low5").isNotNull(), F.col("_low12").isNotNull()
    c5, c12 = F.col("_low5.length_class"), F.col("_low12.length_class")
    final = F.when(c5 != c12, c12).when(c5 == c12, c5)
    exempt = (
        final.isin(*cfg.limit_classes)
        & (F.col("_low5.rate") <= cfg.limit_5yr)
        & (F.col("_low12.rate") <= cfg.limit_12mo)
    )
    eligible = F.coalesce("eligible", F.lit(False))
    uncertified = F.coalesce("_uncertified", F.lit(False)) & eligible
    return joined.select(
        ID,
        eligible.alias("_eligible"),
        *[F.when(F.col("has_attributes"), F.col(c)).alias(c) for c in ATTRIBUTES if c != "status"],
        F.col("_five.rolling_avg").alias("avg_5yr"),
        F.col("_five.rate").alias("rate_5yr"),
        F.col("_five.band").alias("band_5yr"),
        F.col("_five.is_outlier").alias("outlier_5yr"),
        F.col("_twelve.month").alias("month_12mo"),
        F.col("_twelve.rolling_avg").alias("avg_12mo"),
        F.col("_twelve.rate").alias("rate_12mo"),
        F.col("_twelve.band").alias("band_12mo"),
        F.col("_twelve.is_outlier").alias("outlier_12mo"),
        low5.alias("low_5yr"),
        low12.alias("low_12mo"),
        (low5 & low12 & ~F.coalesce(exempt, F.lit(False))).alias("low_both"),
        uncertified.alias("no_certificate"),
        (eligible & ~F.col("has_report")).alias("no_report"),
    )


def listed_assets(facilities: DataFrame, records: DataFrame) -> DataFrame:
    """:func:`combine` from the records: eligible assets with a low score or both gaps,
    one row per name, and the text of their sources."""
    named = keyed(facilities).select(
        ID, "facility_name", F.coalesce(F.col("cs_assessment") == "Yes", F.lit(False)).alias("_yes")
    )
    gap = F.col("_yes") & F.col("no_certificate") & F.col("no_report")
    sources = F.array_compact(
        F.array(
            F.when(F.max("_gap"), F.lit(SOURCE_REPORTING)), F.when(F.max("low_both"), F.lit(SOURCE_SPILLS))
        )
    )
    flags = records.where("_eligible").select(ID, "low_both", "no_certificate", "no_report")
    return (
        named.join(flags, ID)
        .withColumn("_gap", gap)
        .where(F.col("_gap") | F.col("low_both"))
        .groupBy(ID, "facility_name")
        .agg(F.array_join(sources, " & ").alias("source"))
        .select(region(F.nullif(F.col(ID), F.lit(NO_ID))).alias("region"), ID, "facility_name", "source")
    )


def assemble(
    listed: DataFrame,
    facilities: DataFrame,
    records: DataFrame,
    orders: DataFrame,
    spills: DataFrame,
    ordered_ids: DataFrame | None = None,
) -> DataFrame:
    """The wide report, one row per listed asset and facility row.

    All parts have one row per asset id except ``facilities``. ``ordered_ids`` are the
    assets whose order flag is set; without them it is FALSE throughout.
    """
    places = keyed(facilities).select(
        ID,
        "facility_id",
        F.col("facility_name").alias("_name"),
        "program_category",
        "community_type",
        "federal_facility",
    )
    wide = (
        listed.join(places, ID, "left")
        .withColumn("facility_name", F.coalesce("facility_name", "_name"))
        .drop("_name")
        .distinct()
    )
    for part in (records.drop("_eligible"), orders, spills):
        wide = wide.join(part, ID, "left")
    if ordered_ids is None:
        wide = wide.withColumn("has_order", F.lit(False))
    else:
        wide = wide.join(ordered_ids.withColumn("has_order", F.lit(True)), ID, "left")
        wide = wide.withColumn("has_order", F.coalesce("has_order", F.lit(False)))
    three = (F.col("low_both"), F.col("no_certificate"), F.col("no_report"))
    wide = wide.withColumn("reason", reason(*three)).withColumn("criteria_met", criteria_met(*three))
    return layout(wide, list(RESULT_HEADERS))


def summary(report: DataFrame) -> DataFrame:
    """Whole-report counts. As defined, the two "only" counts look at the
    certificate flag alone."""
    low, cert = F.col("low_both"), F.col("no_certificate")
    return report.agg(
        F.count("*").alias("total_systems"),
        F.count_if(low & ~cert).alias("low_perf_only"),
        F.count_if(~low & cert).alias("reporting_only"),
        F.count_if(F.col("criteria_met") > 1).alias("multiple_criteria"),
    )
