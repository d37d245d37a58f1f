import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from culvert.operators import joins, layout, panels, picks, quantiles


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_keys_match_and_blank_does_not(spark):
    left = spark.createDataFrame([(None, 1), ("", 2), ("a", 3)], "k string, v int")
    right = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, w string")
    assert rows(joins.keep_in(left, right, "k")) == [("a", 3), (None, 1)]
    assert rows(joins.keep_not_in(left, right, "k")) == [("", 2)]
    flags = {r.v: r.f for r in joins.flag_in(left, right, "k", "f").collect()}
    assert flags == {1: True, 2: False, 3: True}
    assert rows(joins.full_join(left, right.withColumnRenamed("w", "u"), "k"))[0][1:] == (2, None)
    assert rows(joins.inner_join(left, right, ["k"])) == [("a", 3, "x"), (None, 1, "n")]


@pytest.mark.parametrize("spread", [{}, {"spread": True, "hot_rows": 10}, {"spread": True}])
def test_spread_joins_equal_plain_ones(spark, spread):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("b", 99)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("c", 3)], "k string, w int")
    joined = rows(joins.left_join(left, right, "k", **spread))
    assert len(joined) == 101 and ("b", 99, None) in joined
    assert joins.keep_in(left, right, "k", **spread).count() == 50
    assert rows(joins.keep_not_in(left, right, "k", **spread)) == [("b", 99)]


@pytest.mark.parametrize("limits", [{"hot_rows": 20}, {"hot_pairs": 300}, {"hot_rows": 7, "hot_pairs": 50}, {}])
def test_keys_hot_on_both_sides_become_grids(spark, limits):
    rng = random.Random(2)
    left = [(rng.choice(["hot", "hot", "hot", "b", "c", None]), i) for i in range(400)] + [("lone", i) for i in range(90)]
    right = [(rng.choice(["hot", "hot", "b", None, "d"]), -i) for i in range(150)]
    l, r = spark.createDataFrame(left, "k string, v int"), spark.createDataFrame(right, "k string, w int")
    assert rows(joins.left_join(l, r, "k", spread=True, **limits)) == rows(joins.left_join(l, r, "k"))
    keys = joins.left_join(l, r.withColumn("k2", F.lit(1)), ["k"], spread=True, **limits)
    assert keys.columns == ["k", "v", "w", "k2"] and keys.where("k = 'lone'").count() == 90


def test_cells_of_a_grid_hold_no_more_than_their_part(spark):
    """100,000 x 10,000 rows of one key: every task gets about the same."""
    l = spark.range(100_000).select(F.when(F.col("id") % 4 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    r = spark.range(10_000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("w"))
    pairs = 2_000_000
    grid = joins.grid(l, r, ["k"], joins.HOT_ROWS, pairs).collect()
    assert [(g.k, g._found) for g in grid] == [(7, True)]
    assert 75_000 * 10_000 / (grid[0]._lines * grid[0]._columns) <= pairs
    assert grid[0]._lines / grid[0]._columns == pytest.approx(7.5, rel=0.3)  # copies the fewest rows
    left, right, keys = joins._spread(l, r, ["k"], True, None, pairs)
    cells = left.where("k = 7").groupBy(*keys).count().join(right.groupBy(*keys).agg(F.count("*").alias("other")), keys)
    sizes = [c["count"] * c.other for c in cells.collect()]
    assert len(sizes) == grid[0]._lines * grid[0]._columns and sum(sizes) == 75_000 * 10_000
    assert max(sizes) < 1.2 * np.median(sizes) and max(sizes) < 1.2 * pairs
    assert left.where("k <> 7").count() == 25_000


def test_weighted_count_equals_fan_out(spark):
    rng = random.Random(1)
    left = [(rng.choice(["a", "b", "c", None]), rng.randint(1, 3)) for _ in range(200)]
    right = [(rng.choice(["a", "b", None, "z"]),) for _ in range(30)]
    l = spark.createDataFrame(left, "k string, year int")
    r = spark.createDataFrame(right, "k string")
    literal = joins.left_join(l, r, "k").groupBy("k", "year").agg(F.count("*").alias("n"))
    assert rows(joins.fanout_count(l, r, "k", ["k", "year"])) == rows(literal)


def test_latest_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 3), ("a", 5, 2), ("b", None, 4)], "k string, v int, r int"
    )
    assert rows(picks.latest(df, ["k"], "v", ["r"])) == [("a", 5, 2), ("b", None, 4)]


def test_unique_text_in_order_of_appearance(spark):
    df = spark.createDataFrame(
        [("a", "y", 1), ("a", "x", 2), ("a", "y", 3), ("b", "x", 4)], "k string, v string, r int"
    )
    out = picks.unique_text(df, ["k"], "v", ["r"], "t", "; ")
    assert rows(out) == [("a", "y; x"), ("b", "x")]


def test_label_sources_keeps_null_names(spark):
    a = spark.createDataFrame([("1", None), ("2", "n")], "k string, name string")
    b = spark.createDataFrame([("1", None)], "k string, name string")
    out = picks.label_sources([("A", a), ("B", b)], ["k", "name"])
    assert rows(out) == [("1", None, "A & B"), ("2", "n", "A")]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2,)], "i int")
    assert rows(picks.union_feeds([a, b]).select("i", "s", "_src")) == [(1, "x", 0), (2, None, 1)]


def test_dense_years_are_global(spark):
    df = spark.createDataFrame([("a", 2001, 5), ("b", 2004, 1)], "k string, y int, n long")
    out = rows(panels.densify_global(df, ["k"], "y", "n"))
    assert len(out) == 8 and ("a", 2003, 0) in out and ("b", 2001, 0) in out


def test_dense_months_span_the_entity_and_match_null_keys(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("a", None, d(2020, 1, 1), 2, "S"), ("a", None, d(2020, 3, 1), 1, "S")],
        "k string, len double, m date, n long, cls string",
    )
    out = panels.densify_span(df, ["k", "len"], "m", "n", extra=["cls"]).orderBy("m").collect()
    assert [(r.m.month, r.n, r.cls) for r in out] == [(1, 2, "S"), (2, 0, None), (3, 1, "S")]


def test_gaps_are_emitted_by_the_rows_before_them(spark):
    rng, d = random.Random(6), dt.date
    years = {(rng.choice("abc") if rng.random() < 0.8 else None, rng.randint(1990, 2020)) for _ in range(40)}
    df = spark.createDataFrame([(k, y, 1) for k, y in years] + [("z", None, 9)], "k string, y int, n long")
    lo, hi = min(y for _, y in years), max(y for _, y in years)
    out = rows(panels.densify_global(df, ["k"], "y", "n"))
    assert out == sorted(((k, y, int((k, y) in years)) for k in {k for k, _ in years} for y in range(lo, hi + 1)), key=repr)
    months = {(k, d(y, 1 + y % 12, 1)) for k, y in years}
    df = spark.createDataFrame([(k, m, 3, "S") for k, m in months] + [("z", None, 9, None)], "k string, m date, n long, s string")
    out = panels.densify_span(df, ["k"], "m", "n", extra=["s"]).collect()
    for key in {k for k, _ in months}:
        own = {m for k, m in months if k == key}
        span = [d(i // 12, i % 12 + 1, 1) for i in range(min(own).year * 12 + min(own).month - 1, max(own).year * 12 + max(own).month)]
        got = sorted((r.m, r.n, r.s) for r in out if r.k == key)
        assert got == [(m, 3, "S") if m in own else (m, 0, None) for m in span]


def test_shortcut_equals_dense_rolling_mean(spark):
    rng = random.Random(3)
    data = {
        (f"s{rng.randint(0, 30)}", dt.date(2019 + rng.randint(0, 2), rng.randint(1, 12), 1))
        for _ in range(150)
    }
    df = spark.createDataFrame([(k, m, rng.randint(1, 4)) for k, m in data], "k string, m date, n long")
    dense = panels.densify_span(df, ["k"], "m", "n")
    full = panels.rolling_mean(dense, ["k"], "m", "n", 12, "avg")
    last = picks.latest(full, ["k"], "m", []) .select("k", "m", "avg")
    short = panels.trailing_mean_latest(df, ["k"], "m", "n", 12, "avg").select("k", "m", "avg")
    expected, actual = rows(last), rows(short)
    assert [r[:2] for r in actual] == [r[:2] for r in expected]
    assert [r[2] for r in actual] == pytest.approx([r[2] for r in expected])


def test_span_of_eleven_and_twelve_months(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("a", d(2020, 1, 1), 1), ("a", d(2020, 11, 1), 1), ("b", d(2020, 1, 1), 1), ("b", d(2020, 12, 1), 1)],
        "k string, m date, n long",
    )
    out = panels.trailing_mean_latest(df, ["k"], "m", "n", 12, "avg").collect()
    assert [(r.k, r.avg) for r in out] == [("b", 2 / 12)]


def test_fill_goes_down_then_up(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, None)], "k string, o int, v string")
    assert [r.v for r in panels.fill_down_up(df, ["k"], "o", ["v"]).orderBy("o").collect()] == ["x"] * 3


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 10, 33, 100, 999, 30000])
@pytest.mark.parametrize("ties", [False, True])
def test_quantiles_are_exact(spark, n, ties):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 5, n).astype(float) if ties else rng.lognormal(size=n)
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("g", None), ("h", 2.0)], "c string, x double")
    probs = {"p11": 0.11, "q1": 0.25, "mid": 0.5, "q3": 0.75, "p89": 0.89}
    out = {r.c: r for r in quantiles.exact_quantiles(df, "c", "x", probs).collect()}
    for name, p in probs.items():
        assert out["g"][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert out["h"][name] == 2.0


@pytest.mark.parametrize("kind", ["smooth", "ties", "two", "far", "steps"])
def test_brackets_narrow_until_few_values_are_left(spark, monkeypatch, kind):
    """With little room each quantile takes several rounds; the window that ranks stays small."""
    rng, n = np.random.default_rng(5), 40_000
    values = {
        "smooth": rng.normal(size=n),
        "ties": rng.integers(0, 40, n).astype(float),
        "two": rng.integers(0, 2, n).astype(float),
        "far": np.exp(rng.normal(size=n) * 40),
        "steps": np.where(rng.random(n) < 0.5, 3.0, rng.normal(size=n) * 5),
    }[kind]
    frame = pd.DataFrame({"c": "g", "x": values})
    extra = pd.DataFrame({"c": ["h"] * 9 + [None] * 3, "x": [float(k) for k in range(12)]})
    df = spark.createDataFrame(pd.concat([frame, extra]), "c string, x double")
    probs = {"p0": 0.0, "q1": 0.25, "mid": 0.5, "q3": 0.75, "p999": 0.999, "p1": 1.0}
    rounds, inner = [], quantiles._narrowed

    def counted(data, wide, accuracy):
        rounds.append(len(wide))
        inner(data, wide, accuracy)
        for b in wide:
            assert ((values > b["lo"]) & (values < b["hi"])).sum() <= b["most"] or b["most"] == 0

    monkeypatch.setattr(quantiles, "_narrowed", counted)
    out = {r.c: r for r in quantiles.exact_quantiles(df, "c", "x", probs, room=15).collect()}
    for name, p in probs.items():
        assert out["g"][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
        assert out["h"][name] == np.quantile(range(9), p) and out[None][name] == np.quantile(range(9, 12), p)
    assert len(rounds) <= 4 and (kind != "smooth" or rounds)


def test_audit_and_layout(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v_x int")
    assert rows(layout.audit({"s": df, "empty": df.where("false")}, "k")) == [("empty", 0, 0), ("s", 3, 2)]
    assert layout.layout(df.withColumn("z", F.lit(1)), ["z"], "_x$").columns == ["z", "k"]
