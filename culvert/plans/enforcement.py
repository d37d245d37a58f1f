"""Active orders, their summary, and assets under enforcement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.config import ScreeningConfig
from culvert.functions import region
from culvert.operators.joins import keep_in, keep_not_in
from culvert.plans.facts import ID, keyed

ORDER_ATTRIBUTES = ("population_class", "length_class", "population", "length")


def active_orders(orders: DataFrame, facilities: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """Orders of known facilities: program, both statuses, type and window."""
    start, end = cfg.window("analysis")
    kept = orders.where(
        (F.col("program_category") == cfg.order_program)
        & (F.col("status") == cfg.order_status)
        & (F.col("status_1") == cfg.order_status)
        & F.col("action_type").isin(*cfg.order_types)
        & (F.col("effective_date") >= F.lit(start))
        & (F.col("effective_date") < F.lit(end))
    )
    return keep_in(kept, facilities, "facility_id", spread=True)


def order_summary(orders: DataFrame, key: str, sequence: Sequence[str]) -> DataFrame:
    """Per asset: number of orders, types in order of appearance, last date,
    total amount (an unreadable amount adds nothing).

    Counted per (asset, type) first, then folded to the asset, so that the
    types share the layout of the totals and none is gathered twice.
    """
    position = F.col(sequence[0]) if len(sequence) == 1 else F.struct(*sequence)
    per_type = orders.groupBy(key, "action_type").agg(
        F.min(position).alias("at"),
        F.count("*").alias("n"),
        F.max("effective_date").alias("last"),
        F.sum("amount").alias("total"),
    )
    listed = F.array_sort(F.collect_list(F.struct("at", "action_type")))
    return per_type.groupBy(key).agg(
        F.sum("n").alias("enforcement_count"),
        F.array_join(F.transform(listed, lambda x: x["action_type"]), "; ").alias(
            "enforcement_types"
        ),
        F.max("last").alias("latest_enforcement_date"),
        F.coalesce(F.sum("total"), F.lit(0.0)).alias("total_assessment_amount"),
    )


def under_enforcement(orders: DataFrame, attributes: DataFrame, listed: DataFrame) -> DataFrame:
    """Assets with an active order that are not on the list, with attributes."""
    open_orders = orders.where(F.col(ID).isNotNull()).select(ID, "facility_name").distinct()
    assets = keyed(keep_not_in(open_orders, listed, ID))
    return (
        assets.withColumn("region", region(F.col(ID)))
        .join(attributes.select(ID, *ORDER_ATTRIBUTES), ID, "left")
        .select(ID, "facility_name", "region", *ORDER_ATTRIBUTES)
    )
