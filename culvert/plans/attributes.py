"""One row per asset: status, population, reconciled length, size classes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import LENGTH_CUTS, POPULATION_CUTS, ScreeningConfig
from culvert.functions import classify, reconcile, reconcile_min, rel_diff
from culvert.plans.facts import (
    ID,
    questionnaire_facts,
    report_facts,
    spill_facts,
    spill_rollup,
    systems,
    unkeyed,
)

ATTRIBUTES = (
    "status",
    "population",
    "length_a",
    "length_b",
    "length_diff",
    "length_diff_large",
    "length",
    "population_class",
    "length_class",
)


def system_facts(tables: Mapping[str, DataFrame], rollup: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Every known asset with its attributes and its fan-out weights.

    Assets with counted spills take the first known values in file order and
    reconcile by the discrepancy rule. Eligible assets without take the newest
    report and the smaller length. Others have no attributes
    (``has_attributes`` is FALSE), only weights.
    """
    facts = (
        systems(tables["facilities"])
        .join(spill_facts(rollup), ID, "left")
        .join(report_facts(tables["annual_reports"]), ID, "left")
        .join(questionnaire_facts(tables["questionnaire"]), ID, "left")
    )
    has_new, has_old = F.col("last_new").isNotNull(), F.col("last_old").isNotNull()
    spilled = has_new | has_old

    pop_new = F.when(has_new, F.col("report_population"))
    pop_old = F.when(has_old, F.col("answer_population"))
    newer_wins = pop_new.isNotNull() & (pop_old.isNull() | (F.col("last_new") >= F.col("last_old")))

    a = F.when(spilled, F.when(has_new, F.col("report_length"))).otherwise(
        F.col("newest_length")
    )
    b = F.when(spilled, F.when(has_old, F.col("answer_length"))).otherwise(
        F.when(F.col("in_old_feed"), F.col("first_length"))
    )
    population = F.when(spilled, F.when(newer_wins, pop_new).otherwise(pop_old)).otherwise(
        F.coalesce("newest_population", F.when(F.col("in_old_feed"), F.col("first_population")))
    )
    length = F.when(
        F.col("_spilled"), reconcile(F.col("length_a"), F.col("length_b"), cfg.discrepancy_limit)
    ).otherwise(reconcile_min(F.col("length_a"), F.col("length_b")))
    diff = F.when(F.col("_spilled"), rel_diff(F.col("length_a"), F.col("length_b")))

    single = F.lit(1).cast("long")
    literal = cfg.fanout != "distinct"
    return (
        facts.select(
            ID,
            "eligible",
            spilled.alias("_spilled"),
            "status",
            population.alias("population"),
            a.alias("length_a"),
            b.alias("length_b"),
            (F.coalesce("report_rows", single) if literal else single).alias("new_weight"),
            (F.coalesce("answer_rows", single) if literal else single).alias("old_weight"),
            F.col("report_rows").isNotNull().alias("has_report"),
        )
        .withColumn("has_attributes", F.col("_spilled") | F.col("eligible"))
        .withColumn("length_diff", diff)
        .withColumn("length_diff_large", F.col("length_diff") > cfg.discrepancy_limit)
        .withColumn("length", length)
        .withColumn("population_class", classify(F.col("population"), POPULATION_CUTS))
        .withColumn("length_class", classify(F.col("length"), LENGTH_CUTS))
        .drop("_spilled")
    )


def attributes_of(facts: DataFrame) -> DataFrame:
    """The attribute rows of :func:`system_facts`."""
    return facts.where("has_attributes").select(ID, *ATTRIBUTES)


def system_attributes(tables: Mapping[str, DataFrame], cfg: ScreeningConfig) -> DataFrame:
    """Attributes of all assets that spilled or are eligible."""
    rollup = spill_rollup(tables["new_spills"], tables["old_spills"], cfg)
    return unkeyed(attributes_of(system_facts(tables, rollup, cfg)))
