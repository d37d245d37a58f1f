"""Joins in which a NULL key equals a NULL key.

All of them are equi-joins for Spark, so it picks broadcast, sort-merge or
hash by size; nothing is broadcast by hint here because neither side has a
proven bound. ``spread`` parts hot keys: the rows of both sides are counted per key
first, and a key with too many rows, or too many pairs of them, becomes a grid. Its left
rows are dealt to the grid's lines and copied to each column, its right rows to the
columns and copied to each line, so every pair meets in one cell, and no cell has more
than its part of the rows or of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culvert.operators.cut import written

_SALT = "_salt"
_MATCHED, _FOUND = "_matched", "_found"
#: Rows of one key and side that a task may get, and joined rows it may make of them.
HOT_ROWS = 500_000
HOT_PAIRS = 5_000_000


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def grid(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int, pairs: int) -> DataFrame:
    """``(keys, _found, _lines, _columns)`` of the keys that are too large for one task;
    ``_found`` says whether the right side has it at all.

    Rows are counted in the map tasks, so what is shuffled is a row per key and task. A
    key in the list has over ``rows`` rows or ``2 * sqrt(pairs)`` rows of both sides,
    which bounds the list. Left rows are copied once per column and right rows once per
    line; for the cells that it takes, lines and columns are in proportion to the two
    sides, which copies the fewest rows.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    every = left.select(*keys, one.alias("_l"), none.alias("_r")).unionByName(
        right.select(*keys, none.alias("_l"), one.alias("_r"))
    )
    counted = every.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    l, r = F.col("_l").cast("double"), F.col("_r").cast("double")
    hot = counted.where((F.col("_l") > rows) | (F.col("_r") > rows) | (l * r > pairs))
    cells = l * r / pairs
    return hot.select(
        *keys,
        (F.col("_r") > 0).alias(_FOUND),
        F.ceil(F.greatest(l / rows, F.sqrt(cells * l / F.greatest(r, F.lit(1.0))), F.lit(1.0))).cast("int").alias("_lines"),
        F.ceil(F.greatest(r / rows, F.sqrt(cells * r / F.greatest(l, F.lit(1.0))), F.lit(1.0))).cast("int").alias("_columns"),
    )


def _spread(left: DataFrame, right: DataFrame, keys: list[str], spread: bool, limit: int | None, pairs: int | None):
    if not spread:
        return left, right, keys
    # Stored, so Spark knows how few they are before it plans the joins of the raw rows.
    hot = written(grid(left, right, keys, limit or HOT_ROWS, pairs or HOT_PAIRS), "hot")

    def dealt(df: DataFrame, own: str, other: str, cell: Column) -> DataFrame:
        # The place in the input, not the row's content: equal rows part as well.
        marked = _join(df.withColumn("_at", F.monotonically_increasing_id()), hot, keys, "left")
        placed = marked.withColumn("_own", F.pmod(F.xxhash64("_at"), F.coalesce(own, F.lit(1))).cast("int"))
        copied = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
        return copied.withColumn(_SALT, cell).drop("_at", "_own", "_other", "_lines", "_columns", *[f"_r_{c}" for c in keys])

    columns = F.coalesce("_columns", F.lit(1))
    spread_left = dealt(left, "_lines", "_columns", F.col("_own") * columns + F.col("_other"))
    spread_right = dealt(right, "_columns", "_lines", F.col("_other") * columns + F.col("_own")).drop(_FOUND)
    return spread_left, spread_right, [*keys, _SALT]


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    matches = [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in keys]
    condition: Column = reduce(lambda x, y: x & y, matches)
    return left.join(renamed, condition, how)


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    spread: bool = False,
    hot_rows: int | None = None,
    hot_pairs: int | None = None,
) -> DataFrame:
    """Left join, many-to-many allowed; the key comes from the left side."""
    keys = _keys(on)
    if not spread:
        return _join(left, right, keys, "left").drop(*[f"_r_{c}" for c in keys])
    l, r, salted = _spread(left, right, keys, True, hot_rows, hot_pairs)
    joined = _join(l, r.withColumn(_MATCHED, F.lit(True)), salted, "left")
    # A row stands in several cells; of a key with right rows, cells without any say nothing.
    whole = joined.where(F.col(_MATCHED).isNotNull() | ~F.coalesce(_FOUND, F.lit(False)))
    return whole.drop(*[f"_r_{c}" for c in salted], _SALT, _MATCHED, _FOUND)


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join on one or more nullable keys."""
    keys = _keys(on)
    return _join(left, right, keys, "inner").drop(*[f"_r_{c}" for c in keys])


def full_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Full outer join of two tables with one row per key."""
    joined = _join(left, right, [on], "full")
    rest = [c for c in joined.columns if c not in (on, f"_r_{on}")]
    return joined.select(F.coalesce(on, f"_r_{on}").alias(on), *rest)


def keep_in(
    df: DataFrame, keys_df: DataFrame, on: str | Sequence[str], spread: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Rows whose key occurs in ``keys_df``.

    The key side is made distinct first: map tasks then ship each key once,
    however many rows a hot key has there.
    """
    wanted = keys_df.select(*_keys(on)).distinct()
    l, r, keys = _spread(df, wanted, _keys(on), spread, hot_rows, None)
    return _join(l, r, keys, "left_semi").drop(_SALT, _FOUND)


def keep_not_in(
    df: DataFrame, keys_df: DataFrame, on: str | Sequence[str], spread: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Rows whose key does not occur in ``keys_df``."""
    unwanted = keys_df.select(*_keys(on)).distinct()
    l, r, keys = _spread(df, unwanted, _keys(on), spread, hot_rows, None)
    return _join(l, r, keys, "left_anti").drop(_SALT, _FOUND)


def flag_in(df: DataFrame, keys_df: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: does the key occur in ``keys_df``? Never NULL."""
    marked = keys_df.select(key).distinct().withColumn(name, F.lit(True))
    joined = left_join(df, marked, key)
    return joined.withColumn(name, F.coalesce(name, F.lit(False)))


def attach(
    df: DataFrame, attrs: DataFrame, on: str | Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Left join that brings only ``cols`` of ``attrs``."""
    return left_join(df, attrs.select(*_keys(on), *cols), on)


def fanout_count(
    left: DataFrame, right: DataFrame, on: str, by: Sequence[str], name: str = "n"
) -> DataFrame:
    """Row count per ``by`` of ``left LEFT JOIN right`` without that join.

    Every left row counts once per matching right row, at least once. Both
    sides are counted first, so neither a hot key nor the fan-out is shuffled.
    ``by`` must hold the key and otherwise columns of ``left``.
    """
    counted = left.groupBy(*by).agg(F.count("*").alias("_rows"))
    copies = right.groupBy(on).agg(F.count("*").alias("_copies"))
    weighted = F.col("_rows") * F.coalesce("_copies", F.lit(1))
    return left_join(counted, copies, on).select(*by, weighted.alias(name))
