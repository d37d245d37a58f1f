import datetime as dt

import pytest
from pyspark.sql import functions as F

from culvert import config as k
from culvert import functions as fn


def evaluate(spark, values, expr, schema="a string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.select(expr.alias("x"), "i").orderBy("i").select("x").collect()]


def test_numbers(spark):
    texts = ["1,234", " 12 ", "abc", "", "1d", "1e3", "-.5", "1.2.3", None, "NaN", "12 34"]
    cleaned = evaluate(spark, texts, fn.clean_numeric(F.col("a")))
    assert cleaned == [1234.0, 12.0, None, None, None, 1000.0, -0.5, None, None, None, None]
    plain = evaluate(spark, ["1,234", "1234.50"], fn.plain_numeric(F.col("a")))
    assert plain == [None, 1234.5]


def test_dates_ignore_what_follows(spark):
    texts = [
        "1/2/2021 3:05:59 PM",
        "02/30/2021 00:00",
        "1/2/21 10:00",
        "1/2/2021",
        "12/31/2020 23:59 and more",
        "1/2/2021 25:00",
        "1/2/2021 3:75",
        None,
        "n/a",
    ]
    with_time = evaluate(spark, texts, fn.lenient_date(F.col("a"), "%m/%d/%Y %H:%M"))
    assert with_time == [
        dt.date(2021, 1, 2), None, dt.date(21, 1, 2), None, dt.date(2020, 12, 31),
        None, None, None, None,
    ]
    bare = evaluate(spark, texts[:4], fn.lenient_date(F.col("a"), "%m/%d/%Y"))
    assert bare == [dt.date(2021, 1, 2), None, dt.date(21, 1, 2), dt.date(2021, 1, 2)]


def test_month_labels(spark):
    texts = ["01-Jan-26", "01-JAN-75", "01-jan-68", "01-Jan-69", "01-Jan-2021", "31-Feb-20", "x", None]
    assert evaluate(spark, texts, fn.month_label(F.col("a"))) == [
        dt.date(2026, 1, 1), dt.date(1975, 1, 1), dt.date(2068, 1, 1), dt.date(1969, 1, 1),
        dt.date(2020, 1, 1), None, None, None,
    ]


def test_free_dates(spark):
    texts = ["3 Apr 2021", "03/04/2021", "3-April-21", "31.02.2021", "later", None]
    assert evaluate(spark, texts, fn.free_date(F.col("a"))) == [
        dt.date(2021, 4, 3), dt.date(2021, 4, 3), dt.date(2021, 4, 3), None, None, None,
    ]


def test_null_tokens(spark):
    texts = ["", "NA", "#N/A", "x", None]
    assert evaluate(spark, texts, fn.null_tokens(F.col("a"))) == [None, None, None, "x", None]
    assert evaluate(spark, texts, fn.null_tokens(F.col("a"), ("NA",))) == ["", None, "#N/A", "x", ""]


def test_pattern_keeps_null(spark):
    texts = [None, "lower LATERAL", "Main", ""]
    kept = evaluate(spark, texts, fn.not_matching(F.col("a"), "Lateral"))
    assert kept == [True, False, True, True]


def test_classes_at_their_bounds(spark):
    lengths = [500.0, 499.9, 100.0, 99.9, 25.0, 24.9, 0.0, None]
    assert evaluate(spark, lengths, fn.classify(F.col("a"), k.LENGTH_CUTS), "a double") == [
        "Large", "Medium", "Medium", "Small", "Small", "Micro", "Micro", "Not Available",
    ]
    people = [100000.1, 100000.0, 10000.1, 10000.0, 2500.0, 2499.9, None]
    assert evaluate(spark, people, fn.classify(F.col("a"), k.POPULATION_CUTS), "a double") == [
        "Large", "Medium", "Medium", "Small", "Small", "Micro", "Not Available",
    ]


def test_two_sources(spark):
    a, b = F.col("a"), F.col("b")
    pairs = [(100.0, 70.0), (90.0, 80.0), (0.0, 0.0), (None, 5.0), (5.0, None), (None, None)]
    schema = "a double, b double"
    assert evaluate(spark, pairs, fn.reconcile(a, b), schema) == [70.0, 90.0, 0.0, 5.0, 5.0, None]
    assert evaluate(spark, pairs, fn.reconcile_min(a, b), schema) == [70.0, 80.0, 0.0, 5.0, 5.0, None]
    diffs = evaluate(spark, pairs, fn.rel_diff(a, b), schema)
    assert diffs[0] == pytest.approx(0.3) and diffs[2:] == [None, None, None, None]


def test_scaled_rate_bases(spark):
    pairs = [(1.0, 4.99), (1.0, 5.0), (1.0, 24.99), (1.0, 25.0), (1.0, 0.0), (1.0, None)]
    rates = evaluate(spark, pairs, fn.scaled_rate(F.col("a"), F.col("b")), "a double, b double")
    assert rates[:4] == pytest.approx([5 / 4.99, 5.0, 25 / 24.99, 4.0])
    assert rates[4:] == [None, None]


def test_band_edges(spark):
    rows = [(1.0, 1.0, 3.0), (3.0, 1.0, 3.0), (0.9, 1.0, 3.0), (3.1, 1.0, 3.0), (None, 1.0, 3.0), (1.0, None, None)]
    cols = F.col("a"), F.col("b"), F.col("c")
    assert evaluate(spark, rows, fn.band(*cols), "a double, b double, c double") == [
        k.MEDIUM_PERFORMING, k.MEDIUM_PERFORMING, k.HIGH_PERFORMING, k.LOW_PERFORMING, None, None,
    ]


def test_reasons(spark):
    rows = [(True, True, True), (True, True, False), (False, True, True), (False, True, False)]
    cols = F.col("a"), F.col("b"), F.col("c")
    schema = "a boolean, b boolean, c boolean"
    assert evaluate(spark, rows, fn.reason(*cols), schema) == [
        k.REASON_BOTH, k.REASON_SPILLS, k.REASON_REPORTING, k.REASON_OTHER,
    ]
    assert evaluate(spark, rows, fn.criteria_met(*cols), schema) == [2, 1, 1, 0]
