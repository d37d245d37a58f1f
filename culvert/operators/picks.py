"""First and latest rows, unions, counts, ordered-unique text.

Spark rows have no order, so each pick names the columns that break ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: Sequence[str], tie: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``tie`` order.

    ``row_number() = 1`` lets Spark keep one row per key in every map task
    (WindowGroupLimit) before the shuffle, so a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*tie)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str | Column]
) -> DataFrame:
    """Row with the largest ``by`` per key; NULLs come last, ties by ``tie``."""
    return first_row(df, keys, [F.col(by).desc_nulls_last(), *tie])


def union_feeds(frames: Sequence[DataFrame], src: str = "_src") -> DataFrame:
    """Bag union by name; ``src`` holds the rank of the feed."""
    ranked = [d.withColumn(src, F.lit(i)) for i, d in enumerate(frames)]
    out = ranked[0]
    for d in ranked[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def count_by(df: DataFrame, keys: Sequence[str], name: str = "spill_count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_counts(df: DataFrame, keys: Sequence[str], name: str = "spill_count") -> DataFrame:
    """Sum of counts per key; nothing to add is 0."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(name), F.lit(0)).alias(name))


def unique_text(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str, sep: str
) -> DataFrame:
    """Unique values of a key joined in order of first appearance.

    Repeats are folded to their first position before anything is listed: the
    list holds each distinct value once, whatever the size of the group.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    first_seen = df.groupBy(*keys, value).agg(F.min(position).alias("_at"))
    listed = F.array_sort(F.collect_list(F.struct("_at", value)))
    return first_seen.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.array_join(F.transform(listed, lambda x: x[value]), sep).alias(name)
    )


def label_sources(
    frames: Sequence[tuple[str, DataFrame]], keys: Sequence[str], sep: str = " & "
) -> DataFrame:
    """Which labelled frames hold a key, as one text in frame order."""
    tagged = union_feeds([d.select(*keys).withColumn("source", F.lit(s)) for s, d in frames])
    return unique_text(tagged, keys, "source", ["_src"], "source", sep)
