"""Dense (entity, period, count) panels and trailing means.

A panel is densified by its own rows: each one sees the entity's next period and
emits the gap behind it, so the work is linear in the periods, with one shuffle by
entity and no join. An entity has one row per period (years or months), so a window
stays small for an entity with any number of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _emitted(
    df: DataFrame, keys: Sequence[str], period: str, steps: Column, fills: dict[str, Column]
) -> DataFrame:
    """Every row once per step; only the step of its own period keeps its values."""
    own = F.col("_step") == F.col(period)
    spread = df.withColumn("_step", F.explode(steps))
    return spread.select(
        *keys,
        F.col("_step").alias(period),
        *[F.when(own, F.coalesce(F.col(c), fill)).otherwise(fill).alias(c) for c, fill in fills.items()],
    )


def densify_global(
    df: DataFrame, keys: Sequence[str], period: str, count: str
) -> DataFrame:
    """Every entity gets every integer period of the whole table; gaps are 0.

    ``df`` has one row per entity and period. The two bounds are one row,
    hence the only cross join here.
    """
    bounds = df.agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    w = Window.partitionBy(*keys).orderBy(period)
    known = df.where(F.col(period).isNotNull()).crossJoin(F.broadcast(bounds))
    # The first row also emits what lies before it.
    start = F.when(F.lag(period).over(w).isNull(), F.col("_first")).otherwise(F.col(period))
    end = F.coalesce(F.lead(period).over(w) - 1, F.col("_last"))
    spans = known.withColumns({"_from": start, "_to": F.greatest(end, period)})
    return _emitted(spans, keys, period, F.sequence("_from", "_to"), {count: F.lit(0)})


def densify_span(
    df: DataFrame, keys: Sequence[str], period: str, count: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Every entity gets every month of its own span; gaps are 0.

    ``df`` has one row per entity and month (its first day). ``extra`` columns belong to
    such a row and stay NULL in gaps.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    end = F.coalesce(F.add_months(F.lead(period).over(w), -1), F.col(period))
    spans = df.where(F.col(period).isNotNull()).withColumn("_to", F.greatest(end, period))
    steps = F.sequence(F.col(period), F.col("_to"), F.expr("interval 1 month"))
    fills = {count: F.lit(0), **{c: F.lit(None) for c in extra}}
    return _emitted(spans, keys, period, steps, fills)


def rolling_mean(
    df: DataFrame, keys: Sequence[str], order: str, value: str, n: int, name: str
) -> DataFrame:
    """Mean of the last ``n`` rows of an entity; only full windows are kept."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - n, 0)
    return (
        df.withColumn("_rows", F.count("*").over(w))
        .withColumn(name, F.avg(value).over(w))
        .where(F.col("_rows") == n)
        .drop("_rows")
    )


def trailing_mean_latest(
    df: DataFrame, keys: Sequence[str], period: str, count: str, n: int, name: str
) -> DataFrame:
    """Last row of ``rolling_mean(densify_span(...))`` without the dense panel.

    The window ends at the entity's own last month, so it is the sum of the
    counts of the last ``n`` months over ``n``; entities with a shorter span
    have no full window and drop out.
    """
    w = Window.partitionBy(*keys)
    last = F.max(period).over(w)
    first = F.min(period).over(w)
    recent = F.col(period) > F.add_months("_last", -n)
    return (
        df.where(F.col(period).isNotNull())
        .withColumns({"_last": last, "_first": first})
        .where(F.col("_first") <= F.add_months("_last", 1 - n))
        .groupBy(*keys)
        .agg(
            F.max(period).alias(period),
            (F.coalesce(F.sum(F.when(recent, F.col(count))), F.lit(0)) / n).alias(name),
        )
    )


def fill_down_up(
    df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]
) -> DataFrame:
    """NULLs take the last value before them, else the first one after.

    For panels: one row per entity and period, so a window stays small.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after)
        )
        for c in cols
    }
    return df.withColumns(filled)
