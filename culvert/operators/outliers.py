"""Iterative extreme-deviate test per class (generalised ESD, step-discounted).

Each step removes the value farthest from the mean of what is left, compares
its studentised deviation with a critical value, and the last step above its
critical value decides how many removed values are outliers. At most a share
of a class is removed, and always its current lowest or highest value.

That chain is sequential, but short: only the ``k`` lowest and ``k`` highest
values take part, and everything between them enters as three sums. So Spark
cuts the tails with a sketch, ranks them by a distributed sort, and sums the
rest. A class of up to ``BLOCK`` steps is walked by one task.

Longer ones are cut into segments of ``BLOCK`` steps that are walked at the same time.
A walk over every few thousandth value guesses where each segment begins; then each
begins again where the one before it ended, until none moves. What is left after a
number of steps hardly depends on the beginning, as the walk always makes for
the point where both ends are equally far from the mean, so two rounds are the rule,
whatever ``k`` is; in the worst case each round settles one segment more. The result is
that of the sequential walk in any case: the first segment begins right, and each other
one where its forerunner ended. A task holds four blocks of a class, the driver two
numbers per segment.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culvert.operators.cut import new_table, written
from culvert.operators.quantiles import exact_quantiles

# The task function travels with its helpers: executors need no copy of us.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 250_000
_SHARE = 0.10
_CUT = _SHARE + 0.01
_LOW, _HIGH = 0, 1


def max_deviate(df: DataFrame, cls: str, x: str) -> DataFrame:
    """First step of the test: largest studentised deviation per class."""
    mean, sd = F.avg(x), F.stddev_samp(x)
    farthest = F.greatest(F.max(x) - mean, mean - F.min(x))
    return df.where(F.col(x).isNotNull()).groupBy(cls).agg(
        F.count("*").alias("n"),
        F.when((F.count("*") >= 3) & (F.min(x) < F.max(x)), farthest / sd).alias("r_stat"),
    )


def extreme_candidates(df: DataFrame, cls: str, x: str, ratio: float = _SHARE) -> DataFrame:
    """Rows at or beyond the cuts that hold every value the test can remove."""
    cuts = exact_quantiles(df, cls, x, {"_cut_low": ratio + 0.01, "_cut_high": 0.99 - ratio})
    joined = df.join(cuts, cls)
    outside = (F.col(x) <= F.col("_cut_low")) | (F.col(x) >= F.col("_cut_high"))
    return joined.where(outside).drop("_cut_low", "_cut_high")


def rank_in_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank"
) -> DataFrame:
    """Zero-based rank within a group by a distributed sort.

    Rows are range-partitioned by group and order; a row's rank is its place
    in the partition plus the rows of its group in earlier partitions.
    ``order`` should end in a unique column, then a large group spreads evenly.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [*groups, *order]
    placed = written(
        df.repartitionByRange(parts, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most one row per partition and group: small, so broadcast.
    pieces = (
        placed.groupBy(*groups, "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return (
        placed.join(F.broadcast(pieces), [*groups, "_part"])
        .withColumn(name, F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_part", "_first", "_before")
    )


def _upper_tail(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(T > t) of Student's t for t >= 0, by the incomplete beta function."""
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    flip = x > (a + 1.0) / (a + b + 2.0)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1.0 - x, x)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore"):
        front = np.exp(
            lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(z) + q * np.log1p(-z)
        ) / p
    tiny = 1e-300
    c = np.ones_like(z)
    d = 1.0 - (p + q) * z / (p + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 500):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-13):
            break
    tail = front * h
    return 0.5 * np.where(flip, 1.0 - tail, tail)


def _t_quantile_large(tail: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cornish-Fisher expansion; beyond 2000 degrees of freedom its error is
    below double precision for the tails in use."""
    z = -np.vectorize(NormalDist().inv_cdf, otypes=[float])(tail)
    z2 = z * z
    return z * (
        1
        + (z2 + 1) / (4 * v)
        + ((5 * z2 + 16) * z2 + 3) / (96 * v**2)
        + (((3 * z2 + 19) * z2 + 17) * z2 - 15) / (384 * v**3)
        + ((((79 * z2 + 776) * z2 + 1482) * z2 - 1920) * z2 - 945) / (92160 * v**4)
    )


def t_quantile(tail: np.ndarray, df: np.ndarray) -> np.ndarray:
    """t with P(T > t) = tail < 0.5, for arrays of tails and degrees."""
    tail, df = np.asarray(tail, float), np.asarray(df, float)
    large, out = df > 2000, np.empty(tail.shape)
    if large.any():
        out[large] = _t_quantile_large(tail[large], df[large])
    if not large.all():
        out[~large] = _t_quantile_small(tail[~large], df[~large])
    return out


def _t_quantile_small(tail: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Newton on the log-log scale, where the tail is concave and every step
    after the first closes in from above."""
    log_density = np.vectorize(
        lambda v: math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi),
        otypes=[float],
    )(df)
    u = np.full(tail.shape, 0.5)
    for _ in range(100):
        t = np.exp(u)
        log_tail = np.log(np.maximum(_upper_tail(t, df), 1e-300))
        density = np.exp(log_density - (df + 1) / 2 * np.log1p(t * t / df))
        slope = -density * t / np.exp(log_tail)
        change = (log_tail - np.log(tail)) / slope
        u = u - np.clip(change, -2.0, 2.0)
        if np.all(np.abs(change) < 1e-12):
            break
    return np.exp(u)


def critical_values(n: int, steps: np.ndarray, alpha: float) -> np.ndarray:
    """Critical value of each step for a class of ``n``.

    The step number is taken off twice (once by the shrinking sample), as the
    rule to reproduce has it.
    """
    left = n - 2.0 * steps + 2.0
    df = left - 2.0
    t = t_quantile(alpha / (2.0 * left), df)
    return (left - 1.0) * t / np.sqrt((df + t * t) * left)


def _walker(cls: str, tie: Sequence[str], alpha: float):
    tie = list(tie)

    def walk(block: pd.DataFrame) -> pd.DataFrame:
        state = block.iloc[0]
        n, done = int(state["n"]), int(state["step"])
        low = block[block["side"] == _LOW].sort_values("rank")
        high = block[block["side"] == _HIGH].sort_values("rank")
        lx, hx = low["dev"].to_numpy(), high["dev"].to_numpy()
        # Sums of what is left, added from the inside out: no cancellation.
        s0, q0 = float(state["inner_s"]), float(state["inner_q"])
        ls, lq = (np.cumsum(v[::-1])[::-1] for v in (lx, lx * lx))
        hs, hq = (np.cumsum(v[::-1])[::-1] for v in (hx, hx * hx))
        low_rank, high_rank = low["rank"].to_numpy(), high["rank"].to_numpy()
        i = int(state["a"] - low_rank[0]) if len(lx) else 0
        j = int(state["b"] - high_rank[0]) if len(hx) else 0
        out, stop = [], int(state["stop"])
        while done < stop and i < len(lx) and j < len(hx):
            m = n - done
            if m < 3 or lx[i] >= hx[j]:
                break
            s, q = s0 + ls[i] + hs[j], q0 + lq[i] + hq[j]
            mean = s / m
            below, above = mean - lx[i], hx[j] - mean
            take_low = below > above or (
                below == above and tuple(low.iloc[i][tie]) < tuple(high.iloc[j][tie])
            )
            sd = math.sqrt(max(q - s * mean, 0.0) / (m - 1))
            if sd == 0.0:
                break
            done += 1
            side, rank = (_LOW, low_rank[i]) if take_low else (_HIGH, high_rank[j])
            i, j = (i + 1, j) if take_low else (i, j + 1)
            out.append((done, side, rank, max(below, above) / sd, low_rank[0] + i, high_rank[0] + j))
        log = pd.DataFrame(out, columns=["step", "side", "rank", "r_stat", "a", "b"])
        steps = log["step"].to_numpy(dtype=float)
        log["critical"] = critical_values(n, steps, alpha) if len(steps) else steps
        log.insert(0, cls, state[cls])
        log["seg"] = int(state["seg"])
        return log

    return walk


def _guesser(cls: str, block: int):
    def guess(cells: pd.DataFrame) -> pd.DataFrame:
        """Where the segments of a class begin, from one value and the sum per cell."""
        state = cells.iloc[0]
        n, k, wide, total = int(state["n"]), int(state["k"]), int(state["wide"]), float(state["total"])
        low, high = (cells[cells["side"] == side].sort_values("cell") for side in (_LOW, _HIGH))
        first = [low["least"].to_numpy(), high["most"].to_numpy()]
        gone = [np.concatenate([[0.0], np.cumsum(part["s"].to_numpy())]) for part in (low, high)]
        at, out = [0, 0], []
        while (done := (at[0] + at[1]) * wide) < k and at[0] < len(first[0]) and at[1] < len(first[1]):
            mean = (total - gone[0][at[0]] - gone[1][at[1]]) / max(1, n - done)
            side = _LOW if mean - first[0][at[0]] > first[1][at[1]] - mean else _HIGH
            for start in range(-(-done // block) * block, min(done + wide, k), block):
                a, b = at[0] * wide, at[1] * wide
                out.append((start // block, a + start - done, b) if side == _LOW else (start // block, a, b + start - done))
            at[side] += 1
        found = pd.DataFrame(out, columns=["seg", "a", "b"])
        found.insert(0, cls, state[cls])
        return found

    return guess


def gesd_steps(
    df: DataFrame,
    cls: str,
    x: str,
    tie: Sequence[str],
    alpha: float = 0.05,
    k: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Removal log: per class the removed rows in order, with their studentised
    deviation, critical value and whether they are outliers.

    ``tie`` orders equal deviations and identifies a row within its class.
    ``k`` defaults to a tenth of the class, at least 1. Runs jobs.
    """
    spark = df.sparkSession
    cls_type = df.schema[cls].dataType.simpleString()
    rows = df.where(F.col(x).isNotNull()).select(cls, F.col(x).alias("_x"), *tie)
    # Without a share there is no safe cut, so all values are ranked.
    cut_low, cut_high = (_CUT, 1 - _CUT) if k is None else (1.0, 0.0)
    limit = F.greatest(F.lit(1), F.floor(F.col("n") * _SHARE)) if k is None else F.lit(k)
    sketch = (
        rows.groupBy(cls)
        .agg(
            F.count("*").alias("n"),
            F.percentile_approx("_x", [cut_low, 0.5, cut_high], 10_000).alias("_p"),
        )
        .select(
            cls,
            "n",
            # Past the middle the test has no degrees of freedom left.
            F.greatest(F.least(limit, F.floor((F.col("n") - 1) / 2)), F.lit(0))
            .cast("long")
            .alias("k"),
            F.col("_p")[0].alias("lo"),
            F.col("_p")[1].alias("mid"),
            F.col("_p")[2].alias("hi"),
        )
    )
    known = written(sketch, "classes")
    placed = rows.join(known, cls).withColumn("dev", F.col("_x") - F.col("mid"))

    low_end = F.when(F.col("_x") <= F.col("lo"), F.struct(F.lit(_LOW).alias("side"), F.col("dev").alias("key")))
    high_end = F.when(
        F.col("_x") >= F.col("hi"), F.struct(F.lit(_HIGH).alias("side"), (-F.col("dev")).alias("key"))
    )
    ends = (
        placed.withColumn("_e", F.explode(F.array_compact(F.array(low_end, high_end))))
        .select(cls, "n", "k", "lo", "_x", "dev", F.col("_e.side"), F.col("_e.key"), *tie)
    )
    ranked = rank_in_group(ends, [cls, "side"], ["key", *tie]).withColumn(
        "block", F.floor(F.col("rank") / block)
    )
    # One folder per block, so a round reads the blocks that it walks over and no others.
    removable = written(ranked.where(F.col("rank") < F.col("k")), "tail", "block")

    # What can never be removed (block -1): values between the cuts, and tail
    # values whose rank is k or more from both ends.
    inside = placed.where((F.col("_x") > F.col("lo")) & (F.col("_x") < F.col("hi")))
    kept_low = (F.col("side") == _LOW) & (F.col("rank") < F.col("n") - F.col("k"))
    kept_high = (F.col("side") == _HIGH) & (F.col("_x") > F.col("lo"))
    core = F.lit(_LOW).alias("side"), F.lit(-1).cast("long").alias("block")
    kept = ranked.where((F.col("rank") >= F.col("k")) & (kept_low | kept_high))
    parts = (
        inside.select(cls, "dev", *core)
        .unionByName(kept.select(cls, "dev", *core))
        .unionByName(removable.select(cls, "dev", "side", "block"))
        .groupBy(cls, "side", "block")
        .agg(F.sum("dev").alias("s"), F.sum(F.col("dev") * F.col("dev")).alias("q"))
    )
    sums = written(parts, "tail-sums")

    schema = f"{cls} {cls_type}, step long, side int, rank long, r_stat double, a long, b long, critical double, seg long"
    walk = _walker(cls, tie, alpha)
    logs = new_table(spark, "removed")

    def round_(state: DataFrame, blocks: Sequence[int], number: int) -> None:
        """Walks the segments in ``state``; adds to the log. A segment of ``block`` steps
        needs no more than the rest of its first block and the next one of each side."""
        parted = state.withColumns({"low_block": F.expr(f"a div {block}"), "high_block": F.expr(f"b div {block}")})
        last = F.when(F.col("side") == _LOW, F.col("low_block")).otherwise(F.col("high_block")) + 1
        within = sums.join(parted.select(cls, "seg", "low_block", "high_block"), cls)
        inner = (
            within.where((F.col("block") == -1) | (F.col("block") > last))
            .groupBy(cls, "seg")
            .agg(F.sum("s").alias("inner_s"), F.sum("q").alias("inner_q"))
        )
        current = parted.join(inner, [cls, "seg"], "left").fillna(0.0, ["inner_s", "inner_q"])
        few = removable.where(F.col("block").isin(*blocks)) if len(blocks) <= 1000 else removable
        here = (
            few.drop("n", "k")
            .join(current, cls)
            .where((F.col("block") == last) | (F.col("block") == last - 1))
        )
        walked = here.groupBy(cls, "seg").applyInPandas(walk, schema)
        walked.write.mode("append").parquet(f"{logs}/round={number}")

    zero = F.lit(0).cast("long")
    short = known.where((F.col("k") > 0) & (F.col("k") <= block)).select(
        cls, "n", F.col("k").alias("stop"), *[zero.alias(c) for c in ("seg", "step", "a", "b")]
    )
    # Classes of one segment are through after this, however many there are.
    round_(short, [0], 0)
    steps = spark.read.schema(schema).parquet(f"{logs}/round=0")

    sizes = {r[cls]: (r["n"], r["k"]) for r in known.where(F.col("k") > block).select(cls, "n", "k").collect()}
    if sizes:
        begins = _guesses(spark, known.where(F.col("k") > block), removable, sums, cls, cls_type, block)
        for c, (_, k_) in sizes.items():
            for seg in range(-(-k_ // block)):
                begins.setdefault((c, seg), (seg * block // 2, seg * block - seg * block // 2))
            begins[c, 0] = (0, 0)
        settled = _settled(spark, begins, sizes, round_, f"{cls} {cls_type}", schema, logs, block)
        long_steps = spark.read.schema(f"{schema}, round int").parquet(logs)
        valid = spark.createDataFrame([(c, seg, r) for (c, seg), r in settled.items()], f"{cls} {cls_type}, seg long, round int")
        steps = steps.unionByName(long_steps.join(valid, [cls, "seg", "round"], "left_semi").drop("round"))
    decided = steps.groupBy(cls).agg(
        F.coalesce(F.max(F.when(F.col("r_stat") > F.col("critical"), F.col("step"))), F.lit(0)).alias("_s")
    )
    return (
        steps.join(decided, cls)
        .join(removable.select(cls, "side", "rank", F.col("_x").alias(x), *tie), [cls, "side", "rank"])
        .select(
            cls, "step", *tie, x, "r_stat", "critical",
            (F.col("step") <= F.col("_s")).alias("is_outlier"),
        )
    )


def _guesses(
    spark: SparkSession, known: DataFrame, removable: DataFrame, sums: DataFrame, cls: str, cls_type: str, block: int
) -> dict[tuple, tuple[int, int]]:
    """Where the segments of the long classes may begin: a walk over cells of ranks, a
    sixty-fourth of a segment wide, or as wide as it takes for a million cells."""
    wide = F.greatest(F.lit(max(1, block // 64)), F.ceil(F.col("k") / 1_000_000)).cast("long")
    totals = sums.groupBy(cls).agg(F.sum("s").alias("total"))
    classes = known.select(cls, "n", "k", wide.alias("wide")).join(totals, cls)
    cells = (
        removable.select(cls, "side", "rank", "dev")
        .join(classes.select(cls, "wide"), cls)
        .groupBy(cls, "side", F.expr("rank div wide").alias("cell"))
        .agg(F.sum("dev").alias("s"), F.min("dev").alias("least"), F.max("dev").alias("most"))
    )
    found = cells.join(classes, cls).groupBy(cls).applyInPandas(_guesser(cls, block), f"{cls} {cls_type}, seg long, a long, b long")
    return {(r[cls], r["seg"]): (r["a"], r["b"]) for r in found.collect()}  # two numbers per segment


def _settled(
    spark: SparkSession, begins: dict, sizes: dict, walk_round, cls_field: str, schema: str, logs: str, block: int
) -> dict[tuple, int]:
    """Walks segments until each begins where the one before it ended; returns the round
    that holds the log of each segment that the walk reaches."""
    cls = cls_field.split()[0]
    ends: dict[tuple, tuple[int, int, int]] = {}
    rounds: dict[tuple, int] = {}
    todo, number = set(begins), 0
    while todo:
        number += 1
        rows = [
            (c, sizes[c][0], min(sizes[c][1], (seg + 1) * block), seg, seg * block, *begins[c, seg]) for c, seg in sorted(todo, key=str)
        ]
        state = spark.createDataFrame(rows, f"{cls_field}, n long, stop long, seg long, step long, a long, b long")
        blocks = sorted({x // block + d for _, _, _, _, _, a, b in rows for x in (a, b) for d in (0, 1)})
        walk_round(state, blocks, number)
        log = spark.read.schema(schema).parquet(f"{logs}/round={number}")
        for key in todo:
            rounds[key], ends[key] = number, (key[1] * block, *begins[key])
        for r in log.groupBy(cls, "seg").agg(F.max(F.struct("step", "a", "b")).alias("end")).collect():
            ends[r[cls], r["seg"]] = tuple(r["end"])
        todo, reached = set(), set()
        for c, (_, k) in sizes.items():
            for seg in range(-(-k // block)):
                reached.add((c, seg))
                done, *at = ends[c, seg]
                if done < min(k, (seg + 1) * block) or done == k:
                    break  # the walk ends here
                if tuple(at) != begins[c, seg + 1]:
                    begins[c, seg + 1] = tuple(at)
                    todo.add((c, seg + 1))
    return {key: rounds[key] for key in reached}


def gesd(
    df: DataFrame,
    cls: str,
    x: str,
    tie: Sequence[str],
    alpha: float = 0.05,
    k: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Marks per row: ``cls``, ``tie`` columns and ``is_outlier``. Rows without
    a value get no mark."""
    found = gesd_steps(df, cls, x, tie, alpha, k, block).where("is_outlier")
    marks = found.select(cls, *tie, "is_outlier")
    return (
        df.where(F.col(x).isNotNull())
        .select(cls, *tie)
        .join(marks, [cls, *tie], "left")
        .withColumn("is_outlier", F.coalesce("is_outlier", F.lit(False)))
    )
