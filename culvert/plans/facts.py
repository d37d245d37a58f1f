"""Compact per-asset facts of the feeds.

``NO_ID`` stands for a missing asset id inside the job. Ids then compare with
plain equality, which is what lets joins and aggregations on the id share one
hash layout; a NULL-safe condition would force another shuffle each time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culvert.config import ScreeningConfig
from culvert.functions import not_matching
from culvert.operators.joins import keep_in

NO_ID = "\u0001"
ID = "wdid"
NEW, OLD = 0, 1


def keyed(df: DataFrame) -> DataFrame:
    """Missing ids as ``NO_ID``."""
    return df.withColumn(ID, F.coalesce(ID, F.lit(NO_ID)))


def unkeyed(df: DataFrame) -> DataFrame:
    """``NO_ID`` as a missing id again."""
    return df.withColumn(ID, F.nullif(F.col(ID), F.lit(NO_ID)))


def in_scope(cfg: ScreeningConfig, types: tuple[str, ...]) -> Column:
    """Spills the criteria count: in the window, of a counted type, and not at
    an excluded place. Never NULL."""
    start, end = cfg.window("analysis")
    when = (F.col("spill_date") >= F.lit(start)) & (F.col("spill_date") < F.lit(end))
    kept = when & F.col("spill_type").isin(*types) & not_matching(F.col("location"), cfg.excluded_pattern)
    return F.coalesce(kept, F.lit(False))


def clean_feed(
    df: DataFrame, known: DataFrame, cfg: ScreeningConfig, types: tuple[str, ...]
) -> DataFrame:
    """Spill rows of known assets that the criteria count, with their year."""
    scoped = df.where(in_scope(cfg, types)).withColumn("spill_year", F.year("spill_date"))
    return keep_in(scoped, known, ID, spread=True)


def systems(facilities: DataFrame) -> DataFrame:
    """One row per asset id: does any of its facility rows count as eligible?"""
    yes = F.coalesce(F.col("cs_assessment") == "Yes", F.lit(False))
    return keyed(facilities).groupBy(ID).agg(F.max(yes).alias("eligible"))


def spill_rollup(new: DataFrame, old: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Row counts per (id, feed, month, type, status, in scope).

    One pass over the spill feeds; all keys and buffers are hash-aggregated in
    the map tasks, so a hot asset leaves each of them as a few rows. Rows out of
    scope keep no more than the job needs: the month in the newer feed (for the
    12-month rate), only their presence in the older one.
    """

    def folded(df: DataFrame, feed: int, types: tuple[str, ...]) -> DataFrame:
        scope = in_scope(cfg, types)
        month = F.trunc("spill_date", "month")
        return keyed(df).select(
            ID,
            F.lit(feed).alias("feed"),
            (month if feed == NEW else F.when(scope, month)).alias("month"),
            F.when(scope, F.col("spill_type")).alias("spill_type"),
            F.when(scope, F.col("status")).alias("status"),
            scope.alias("in_scope"),
            "row_no",
        )

    rows = folded(new, NEW, cfg.new_types).unionByName(folded(old, OLD, cfg.old_types))
    return (
        rows.groupBy(ID, "feed", "month", "spill_type", "status", "in_scope")
        .agg(F.count("*").alias("rows"), F.min("row_no").alias("first_row"))
        .repartition(ID)
    )


def spill_facts(rollup: DataFrame) -> DataFrame:
    """Per asset: last counted year of each feed, status, presence in the old feed."""
    year = F.when(F.col("in_scope"), F.year("month"))
    newest = F.when(F.col("in_scope"), F.struct(-F.year("month"), F.col("feed"), F.col("first_row")))
    return rollup.groupBy(ID).agg(
        F.max(F.when(F.col("feed") == NEW, year)).alias("last_new"),
        F.max(F.when(F.col("feed") == OLD, year)).alias("last_old"),
        F.max(F.col("feed") == OLD).alias("in_old_feed"),
        F.min_by("status", newest).alias("status"),
    )


def _known(c: str) -> Column:
    """Row number of rows that have ``c``."""
    return F.when(F.col(c).isNotNull(), F.col("row_no"))


def report_facts(reports: DataFrame) -> DataFrame:
    """Per asset: number of reports, first known length and population in file
    order, and both values of the newest report that has either.

    Recency (newest year, then first in file) is one decimal: buffers of fixed
    width keep this a hash aggregation, where a struct would mean sorting the
    reports in every map task.
    """
    either = F.col("length").isNotNull() | F.col("population").isNotNull()
    year = F.coalesce(F.col("report_year").try_cast("decimal(5,0)"), F.lit(-9999))
    place = year * F.lit(Decimal(10**19)) - F.col("row_no").cast("decimal(20,0)")
    recency = F.when(either, place.cast("decimal(38,0)"))
    return (
        keyed(reports)
        .groupBy(ID)
        .agg(
            F.count("*").alias("report_rows"),
            F.min_by("length", _known("length")).alias("report_length"),
            F.min_by("population", _known("population")).alias("report_population"),
            F.max_by("length", recency).alias("newest_length"),
            F.max_by("population", recency).alias("newest_population"),
        )
    )


def questionnaire_facts(questionnaire: DataFrame) -> DataFrame:
    """Per asset: number of rows, first known length and population in file
    order, and both values of the first row that has either."""
    either = F.col("length").isNotNull() | F.col("population").isNotNull()
    first = F.when(either, F.col("row_no"))
    return (
        keyed(questionnaire)
        .groupBy(ID)
        .agg(
            F.count("*").alias("answer_rows"),
            F.min_by("length", _known("length")).alias("answer_length"),
            F.min_by("population", _known("population")).alias("answer_population"),
            F.min_by("length", first).alias("first_length"),
            F.min_by("population", first).alias("first_population"),
        )
    )
