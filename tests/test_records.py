"""Quoted records read in parallel, against one task that reads a whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from culvert.sources import read_delimited, read_records
from culvert.sources.records import ends_inside

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    """Splits of 2,000 bytes."""
    names = (SPLIT, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ("2000", "0", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def one_task(spark, path, sep=","):
    reader = spark.read.option("header", True).option("multiLine", True).option("sep", sep).option("quote", '"').option("escape", '"')
    rows = reader.option("nullValue", "\u0001").csv(path).collect()
    return [tuple("" if v is None else v for v in r) for r in rows]


def wordy(rng, rows, columns=3):
    """Rows whose fields hold separators, quotes and line breaks, some of them long."""
    def field():
        kind = rng.random()
        if kind < 0.55:
            return f"w{rng.randint(0, 999)}"
        if kind < 0.6:
            return "\n" * rng.randint(1, 40)
        return "".join(rng.choice(['"', '""', "\n", ",", "\t", " ", "ü", "x", "\n\n", '"\n', '\n"', '",\n"']) for _ in range(rng.randint(0, 12)))

    return [[str(k), *(field() for _ in range(columns - 1))] for k in range(rows)]


def text(rows, sep=",", end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator=end).writerows(rows)
    return out.getvalue()


def got(df, drop=()):
    rows = [tuple(r) for r in df.drop(*drop).orderBy("row_no").collect()]
    assert [r[-1] for r in rows] == list(range(len(rows)))
    return [r[:-1] for r in rows]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_many_splits_equal_one_task(spark, tmp_path, small_splits, sep):
    path = str(tmp_path / "feed.csv")
    rows = wordy(random.Random(4), 1000)
    with open(path, "w", newline="") as f:
        f.write(text([["ID", "A", "B"], *rows], sep))
    df = read_delimited(spark, path, sep=sep, tokens=())
    records = read_records(spark, path, sep)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() >= 8
    assert records.count() == 1001
    found = got(df)
    assert found == [tuple(r) for r in rows]
    assert found == one_task(spark, path, sep)


def test_field_longer_than_many_splits(spark, tmp_path, small_splits):
    path = str(tmp_path / "long.csv")
    rows = [["1", "a"], ["2", "line\n" * 8000], ["3", "b"], ["4", '"\n' * 3000 + "end"], ["5", "x" * 30_000]]
    with open(path, "w", newline="") as f:
        f.write(text([["ID", "T"], *rows]))
    assert got(read_delimited(spark, path, tokens=())) == [tuple(r) for r in rows]


def test_files_in_order_with_headers_over_several_lines(spark, tmp_path, small_splits):
    folder, every = tmp_path / "feed", []
    folder.mkdir()
    rng = random.Random(8)
    for k, size in enumerate([0, 400, 1, 250]):
        rows = wordy(rng, size, 2)
        every += rows
        (folder / f"part-{k}.csv").write_text(("﻿" if k % 2 else "") + text([["ID", 'two\n"lines"'], *rows]), newline="")
    df = read_delimited(spark, str(folder), tokens=())
    assert df.columns == ["ID", "two..lines.", "row_no"]
    assert got(df) == [tuple(r) for r in every]


def test_headers_must_agree_and_quotes_must_close(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("A,B\n1,2\n")
    (tmp_path / "a" / "2.csv").write_text('A,"B"\n3,4\n')
    assert got(read_delimited(spark, str(tmp_path / "a"))) == [("1", "2"), ("3", "4")]
    (tmp_path / "a" / "3.csv").write_text("A,C\n5,6\n")
    with pytest.raises(ValueError, match="3.csv"):
        read_delimited(spark, str(tmp_path / "a"))
    (tmp_path / "open.csv").write_text('A,B\n1,"2\n3,4\n')
    with pytest.raises(ValueError, match="open.csv"):
        read_delimited(spark, str(tmp_path / "open.csv"))
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_delimited(spark, str(tmp_path / "none.csv"))


def test_stray_quotes_blank_lines_carriage_returns_and_odd_rows(spark, tmp_path, small_splits):
    path = str(tmp_path / "odd.csv")
    body = 'A,B,C\r\n1,5" pipe,x\r\n\r\n2,a"b"c,"q ""r"" s"\r\n3,"x\r\ny",\r\n4,only\r\n5,,"",more\r\n'
    with open(path, "w", newline="") as f:
        f.write(body)
    found = got(read_delimited(spark, path, tokens=()))
    assert found[0] == ("1", '5" pipe', "x") and found[1] == ("2", 'a"b"c', 'q "r" s')
    assert found[2][0] == "3" and found[2][1].replace("\r", "") == "x\ny"
    assert found[3] == ("4", "only", "") and found[4] == ("5", "", "")
    assert [r[0] for r in one_task(spark, path)] == [r[0] for r in found]


def test_rows_and_numbers_survive_another_split_size(spark, tmp_path):
    """The stored lines are read again with splits of another size, as after executors came or went."""
    path, n = str(tmp_path / "feed.csv"), 20_000
    with open(path, "w") as f:
        f.write("ID,T\n" + "".join(f'{k},"{"x" * 20}\n"\n' if k % 50 == 0 else f"{k},{'y' * 20}\n" for k in range(n)))
    before = {c: spark.conf.get(c) for c in (SPLIT, "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set(SPLIT, "100000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        frames = [read_delimited(spark, path)]
        frames.append(read_delimited(spark, str(path), multiline=False).where(F.col("T").startswith("y")))
        spark.conf.set(SPLIT, "7777")
        whole, lines = frames
        assert whole.select(F.col("ID").cast("int").alias("i"), "row_no").where("i = row_no").count() == n
        assert lines.select("ID", "row_no").distinct().count() == n - n // 50
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


@pytest.mark.parametrize(
    "line, outside, inside",
    [("a,b", False, True), ('a,"b', True, False), ('"', True, False), ('""', False, True), ('"""', True, False), ('a"b', False, False),
     ('x""', False, True), ('x"",y', False, True), ('x",y', False, False), ('x","y', True, True), ('5" a,"b', True, True), ("", False, True)],
)
def test_line_ends(line, outside, inside):
    assert (ends_inside(line, ",", False), ends_inside(line, ",", True)) == (outside, inside)
