"""Exact quantiles of a few large groups, without gathering a group.

``percentile`` keeps every distinct value of a group in one buffer. Here a sketch of
fixed size brackets each quantile, and as long as a bracket holds more values than
``ROOM``, a sketch of the values inside narrows it, by about 1,000 times in each round.
A last pass counts what lies below a bracket and keeps single values inside it, so
the window that reads off the order statistics never gets more than ``ROOM`` of them,
whatever the size of the group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ACCURACY = 10_000
# Half width of the first bracket: ten times the rank error of the sketch.
_MARGIN = 10 / _ACCURACY
# Quantiles in the sketch of a bracket, from its least to its largest value.
_STEPS = 2_000
#: Distinct values between the ends of a bracket that are ranked in one task, at most.
ROOM = 20_000


def _first_brackets(rows: DataFrame, probs: list[float], accuracy: int) -> list[dict[str, Any]]:
    cuts = []
    for p in probs:
        cuts += [max(p - _MARGIN, 0.0), min(p + _MARGIN, 1.0)]
    sketch = rows.groupBy("_g").agg(F.count("*").alias("n"), F.percentile_approx("_x", cuts, accuracy).alias("c"))
    return [
        {"_g": r._g, "_n": r.n, "i": i, "p": p, "lo": r.c[2 * i], "hi": r.c[2 * i + 1], "most": math.ceil(4 * _MARGIN * r.n)}
        for r in sketch.collect()  # one row per group
        for i, p in enumerate(probs)
    ]


def _frame(rows: DataFrame, brackets: list[dict[str, Any]]) -> DataFrame:
    """The brackets as a table: one row per group and quantile."""
    group, value = rows.schema["_g"].dataType, rows.schema["_x"].dataType
    schema = T.StructType(
        [T.StructField("_g", group), T.StructField("_n", T.LongType()), T.StructField("i", T.IntegerType()), T.StructField("p", T.DoubleType())]
        + [T.StructField(c, value) for c in ("lo", "hi")]
    )
    return rows.sparkSession.createDataFrame([tuple(b[f.name] for f in schema) for b in brackets], schema)


def _narrowed(rows: DataFrame, wide: list[dict[str, Any]], accuracy: int) -> None:
    """One pass over the rows; brackets become what a sketch of their inside allows."""
    brackets = F.broadcast(_frame(rows, wide))  # groups times quantiles
    inside = F.col("_x").between(F.col("lo"), F.col("hi"))
    between = (F.col("_x") > F.col("lo")) & (F.col("_x") < F.col("hi"))
    steps = [k / _STEPS for k in range(_STEPS + 1)]
    found = (
        rows.alias("r")
        .join(brackets.alias("b"), F.expr("r._g <=> b._g"))
        .groupBy("b._g", "i")
        .agg(
            F.count_if(F.col("_x") < F.col("lo")).alias("below"),
            F.count_if(inside).alias("inside"),
            F.count_if(between).alias("between"),
            F.percentile_approx(F.when(inside, F.col("_x")), steps, accuracy).alias("c"),
        )
    )
    got = {(r._g, r.i): r for r in found.collect()}  # as many rows as brackets
    spare = math.ceil(2 * _STEPS / accuracy) + 1
    for b in wide:
        r = got[b["_g"], b["i"]]
        b["most"] = r.between
        low = math.floor((b["_n"] - 1) * b["p"]) - r.below  # place of the lower order statistic inside
        first = max(0, math.floor(low / max(1, r.inside) * _STEPS) - spare)
        last = min(_STEPS, math.ceil((low + 2) / max(1, r.inside) * _STEPS) + spare)
        lo, hi = r.c[first], r.c[last]
        if r.between > 0 and (lo, hi) != (b["lo"], b["hi"]):
            b |= {"lo": lo, "hi": hi, "most": min(r.between, math.ceil(r.inside * (last - first + spare) / _STEPS))}
        else:  # the ends hold nearly all rows: nothing more to gain
            b["most"] = min(r.between, 0)


def exact_quantiles(
    df: DataFrame, group: str, value: str, probs: Mapping[str, float], room: int = ROOM, accuracy: int = _ACCURACY
) -> DataFrame:
    """One row per group with one column per entry of ``probs``.

    Linear interpolation between order statistics at ``(n - 1) * p``. NULL
    values are skipped. ``group`` must have few values (size classes): the
    brackets, one row per group and quantile, pass through the driver and are broadcast.
    A group with fewer values than about 250 times ``room`` takes two passes, each
    factor of 1,000 more another one.
    """
    rows = df.where(F.col(value).isNotNull()).select(
        F.col(group).alias("_g"), F.col(value).alias("_x")
    )
    names = list(probs)
    found = _first_brackets(rows, list(probs.values()), accuracy)
    while wide := [b for b in found if b["most"] > room and b["lo"] != b["hi"]]:
        _narrowed(rows, wide, accuracy)
    brackets = _frame(rows, found)

    # zone -1: below the bracket, 0: inside (kept by value), 1: above.
    zone = F.when(F.col("_x") < F.col("lo"), -1).when(F.col("_x") > F.col("hi"), 1).otherwise(0)
    located = (
        rows.alias("r")
        .join(F.broadcast(brackets).alias("b"), F.expr("r._g <=> b._g"))
        .select("b._g", "_n", "i", "p", "_x", zone.alias("zone"))
    )
    points = located.groupBy(
        "_g", "_n", "i", "p", "zone", F.when(F.col("zone") == 0, F.col("_x")).alias("_v")
    ).agg(F.count("*").alias("w"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))

    # Of the values below only the largest, of those above only the smallest
    # has a known rank.
    point = F.when(F.col("zone") < 0, F.col("_max")).otherwise(F.col("_min"))
    running = F.sum("w").over(Window.partitionBy("_g", "i").orderBy("zone", "_v"))
    ranked = points.withColumn("_x", point).withColumn("_to", running)
    ranked = ranked.withColumn(
        "_from",
        F.when(F.col("zone") < 0, F.col("_to")).otherwise(F.col("_to") - F.col("w") + 1),
    ).withColumn("_to", F.when(F.col("zone") > 0, F.col("_from")).otherwise(F.col("_to")))

    at = (F.col("_n") - 1) * F.col("p")
    low_rank = F.floor(at) + 1
    high_rank = F.least(low_rank + 1, F.col("_n"))

    def value_at(rank):
        return F.max(F.when(rank.between(F.col("_from"), F.col("_to")), F.col("_x")))

    picked = (
        ranked.groupBy("_g", "_n", "i", "p")
        .agg(value_at(low_rank).alias("_l"), value_at(high_rank).alias("_h"))
        .withColumn("_q", F.col("_l") + (at - F.floor(at)) * (F.col("_h") - F.col("_l")))
        .withColumn(
            "_q",
            F.coalesce("_q", F.raise_error(F.lit("quantile outside its bracket")).cast("double")),
        )
    )
    return picked.groupBy(F.col("_g").alias(group)).agg(
        *[F.max(F.when(F.col("i") == i, F.col("_q"))).alias(c) for i, c in enumerate(names)]
    )


def quartiles(df: DataFrame, cls: str, x: str, names=("q1", "q3")) -> DataFrame:
    """First and third quartile of ``x`` per class."""
    return exact_quantiles(df, cls, x, {names[0]: 0.25, names[1]: 0.75})
