import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from culvert.config import ScreeningConfig
from culvert.plans import RESULT_HEADERS, screen
from culvert.sources import (
    Publication,
    as_of,
    from_folder,
    normalise_headers,
    published,
    read_delimited,
    read_published,
    read_snapshot,
    write_result,
    write_snapshot,
)


def test_headers():
    assert normalise_headers(["A B", "STATUS", "STATUS", "1x", "NO_SPILLS (0-No 1-Yes)"]) == [
        "A.B", "STATUS", "STATUS.1", "X1x", "NO_SPILLS..0.No.1.Yes.",
    ]
    assert normalise_headers(["a b"], upper=True, mangle=False) == ["A B"]


def write(path, rows, sep=","):
    with open(path, "w", newline="") as f:
        csv.writer(f, delimiter=sep, quoting=csv.QUOTE_MINIMAL).writerows(rows)


def test_quotes_breaks_tokens_and_order(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write(path, [["A", "S", "S"], ["x", "two\nlines", 'say "hi"'], ["", "NA", "#N/A"], ["z", "1,2", "3"]])
    rows = read_delimited(spark, path).orderBy("row_no").collect()
    assert [(r[0], r[1], r[2]) for r in rows] == [
        ("x", "two\nlines", 'say "hi"'), ("", None, "#N/A"), ("z", "1,2", "3"),
    ]
    strict = read_delimited(spark, path, tokens=("", "NA", "#N/A")).orderBy("row_no").collect()
    assert tuple(strict[1])[:3] == (None, None, None)
    assert read_delimited(spark, path).columns == ["A", "S", "S.1", "row_no"]


@pytest.mark.parametrize("multiline", [True, False])
def test_row_order_over_many_files(spark, tmp_path, multiline):
    folder = tmp_path / "feed"
    folder.mkdir()
    sizes, n = [5, 3000, 40, 700], 0
    for i, size in enumerate(sizes):
        write(folder / f"part-{i}.tsv", [["ID"]] + [[str(n + j)] for j in range(size)], sep="\t")
        n += size
    df = read_delimited(spark, str(folder), sep="\t", multiline=multiline)
    assert [int(r.ID) for r in df.orderBy("row_no").collect()] == list(range(n))


def test_row_order_in_split_files(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as f:
        f.write("ID,TEXT\n")
        for i in range(120_000):
            f.write(f"{i},{'x' * 90}\n")
    df = read_delimited(spark, path, multiline=False)
    assert df.rdd.getNumPartitions() > 1
    ordered = df.select(F.col("ID").cast("long").alias("id"), "row_no")
    first = ordered.agg(F.count("*"), F.count_distinct("row_no")).first()
    assert tuple(first) == (120_000, 120_000)
    assert [r.id for r in ordered.orderBy("row_no").select("id").collect()] == list(range(120_000))


def test_snapshots(spark, tmp_path):
    root, day, other = str(tmp_path / "snap"), dt.date(2026, 4, 13), dt.date(2026, 4, 14)
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_snapshot(df, root, "t", day)
    write_snapshot(df.withColumn("v", F.lit(2)), root, "t", other)
    write_snapshot(df.withColumn("v", F.lit(3)), root, "t", day)
    assert [tuple(r) for r in read_snapshot(spark, root, "t", day).collect()] == [("a", 3)]
    assert [tuple(r) for r in read_snapshot(spark, root, "t", other).collect()] == [("a", 2)]
    assert as_of(spark.read.parquet(f"{root}/t"), other).count() == 1
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "t", dt.date(2020, 1, 1))


def test_runs_are_published_whole(spark, tmp_path):
    root, day, later = str(tmp_path / "out"), dt.date(2026, 4, 13), dt.date(2026, 4, 14)
    df = spark.createDataFrame([("a", 1)], "k string, v int")

    def run(when, v, *names, fmt="parquet"):
        with Publication(spark, root, when) as out:
            for n in names:
                out.add(n, df.withColumn("v", F.lit(v)), {"k": "K.NAME"}, fmt)
        return out

    def read(name, when=None):
        return [tuple(r) for r in read_published(spark, root, name, when).collect()]

    with pytest.raises(FileNotFoundError):
        read("t")
    run(day, 1, "t", "u")
    assert read("t") == read("u") == read("t", day) == [("a", 1)]
    assert read_published(spark, root, "t").columns == ["K.NAME", "v"]
    run(later, 2, "t")
    assert read("t") == [("a", 2)] and read("t", day) == [("a", 1)]
    with pytest.raises(FileNotFoundError):
        read("u")  # the newest run has none
    with pytest.raises(RuntimeError):  # ends between two writes
        with Publication(spark, root, later) as out:
            out.add("t", df.withColumn("v", F.lit(3)))
            raise RuntimeError
    assert not out.committed and read("t") == [("a", 2)] and published(spark, root).count() == 3
    second = run(day, 4, "t", "u", fmt="csv")  # once more for an earlier day
    assert read("t", day) == read("u", day) == [("a", 4)] and read("t") == [("a", 2)]
    assert {r.run_id for r in published(spark, root).where(F.col("run_date") == day).collect()} == {second.run_id}
    with pytest.raises(ValueError):
        second.add("v", df)
    with pytest.raises(ValueError):
        second.commit()


def test_results(spark, tmp_path):
    df = spark.createDataFrame([("1", "n")], "wdid string, facility_name string")
    for fmt in ("csv", "parquet"):
        for _ in range(2):
            path = write_result(df, str(tmp_path / fmt), "report", dt.date(2026, 4, 13), RESULT_HEADERS, fmt)
        reader = spark.read.option("header", True)
        back = reader.csv(path) if fmt == "csv" else reader.parquet(path)
        assert back.columns == ["WDID", "FACILITY.NAME"] and back.count() == 1
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path), "report", dt.date(2026, 4, 13), fmt="xlsx")


def feeds(folder, sep, suffix):
    """A fleet as raw feeds: six systems, spills in five years."""
    ids = [str(i) for i in range(1, 7)]
    stamps = [f"{m}/15/{y} 3:05:59 PM" for y in range(2021, 2026) for m in (1, 12)]
    write(folder / "facilities.csv", [
        ["WDID", "FACILITY ID", "FACILITY NAME", "PROGRAM CATEGORY", "COMMUNITY TYPE", "FEDERAL FACILITY", "CS ASSESSMENT"],
        *[[i, f"F{i}", f"Name {i}", "SSO", "#N/A", "", "Yes"] for i in ids],
    ])
    write(folder / f"Cat1_2_3{suffix}", [
        ["WDID", "ESTIMATED_SPILL_START_DATE_AND_TIME", "SPILL_TYPE", "APPEARANCE_POINTS", "STATUS"],
        *[[i, s, "Category 1 Spill", "Main\nline", "Active"] for i in ids for s in stamps for _ in range(int(i))],
        ["1", "12/15/2025 10:00", "Category 1 Spill", "Upper Lateral", "Active"],
    ], sep)
    write(folder / f"SSO{suffix}", [
        ["WDID", "START.DT", "SPILL.TYPE", "WHERE.FAILURE.OCCUR", "STATUS"],
        ["6", "2/1/2021", "Category 2", "Main", "Active"],
    ], sep)
    write(folder / f"AnnualReports{suffix}", [
        ["WDID", "ANNUAL_REPORT_YEAR", "POP_SERVED", "MILES_FORCED_MAINS", "MILES_GRAVITY_SEWERS", "LAST_UPDATED_ON"],
        ["1", "2021", "9,000", "100", "", "1 May 2022"],
        *[[i, "2022", "12,000", "50.5", "69.5", "1 May 2023"] for i in ids],
    ], sep)
    write(folder / f"Questionnaire{suffix}", [
        ["WDID", "ssoq.population.served", "ssoq_miles_of_force_main", "ssoq_miles_of_gravity_sewer"],
        ["6", "12,500", "10", "100"],
    ], sep)
    write(folder / f"neworder_no_spills{suffix}", [
        ["WDID", "SEWER_SYSTEM_NAME", "MONTH_YEAR", "CAT_1_2_3_SPILL_COUNT", "NO_SPILLS..0.No.1.Yes."],
        ["1", "Name 1", "01-Mar-25", "0", "1"],
    ], sep)
    write(folder / "enforcement.csv", [
        ["FACILITY ID", "WDID", "FACILITY NAME", "PROGRAM CATEGORY", "STATUS", "ENFORCEMENT ACTION TYPE", "EFFECTIVE DATE", "STATUS", "EFFECTIVE DATE", "TOTAL ASSESSMENT AMOUNT"],
        ["F6", "6", "Name 6", "SSO", "Active", "Notice of Violation", "x", "Active", "5/1/2022", "1,234"],
        ["F1", "1", "Name 1", "SSO", "Active", "Notice of Violation", "x", "Closed", "5/1/2022", "10"],
    ])


@pytest.mark.parametrize("sep,suffix", [(",", ".csv"), ("\t", ".txt")])
def test_feeds_to_report(spark, tmp_path, sep, suffix):
    feeds(tmp_path, sep, suffix)
    t = from_folder(spark, str(tmp_path), suffix=suffix, sep=sep, mangle=suffix == ".txt")
    reports = {(r.wdid, r.report_year): (r.population, r.length) for r in t["annual_reports"].collect()}
    assert reports["1", 2021] == (9000.0, None) and reports["2", 2022] == (12000.0, 120.0)
    facility = t["facilities"].first()
    assert facility.community_type is None and facility.federal_facility is None
    run = screen(t, ScreeningConfig())
    rows = {r.wdid: r for r in run.report.collect()}
    assert set(rows) == {"5", "6"}
    six = rows["6"]
    assert six.length == 120.0 and six.length_b == 110.0 and six.length_class == "Medium"
    assert six.total_spills == 61 and six.cat2_spills == 1
    assert six.enforcement_count == 1 and six.total_assessment_amount == 0.0
    # System 1 counts twice: it has two reports. Its order is not active.
    twice = next(r for r in run.rates_5yr.collect() if r.wdid == "1")
    assert twice.rolling_avg == 4.0 and rows["5"].enforcement_count is None
    run.release()


def test_fresh_run_then_replay(spark, tmp_path):
    from culvert import run as runner

    feeds(tmp_path, "\t", ".txt")
    places = (str(tmp_path), str(tmp_path), str(tmp_path / "snapshots"))
    day = dt.date(2026, 4, 13)
    fresh = screen(runner.load(spark, *places, today=day))
    paths = runner.publish(fresh, str(tmp_path / "out"), day)
    report = spark.read.option("header", True).csv(paths["report"])
    assert report.columns == list(RESULT_HEADERS.values()) and report.count() == 2
    audit = {r.stage: int(r.row_count) for r in spark.read.option("header", True).csv(paths["audit"]).collect()}
    assert audit["report"] == 2 and audit["rates_5yr"] == 6
    replay = screen(runner.load(spark, "nowhere", places[1], places[2], snapshot=day))
    assert sorted(map(repr, replay.report.collect())) == sorted(map(repr, fresh.report.collect()))
    with pytest.raises(FileNotFoundError):
        runner.load(spark, "nowhere", places[1], places[2], snapshot=dt.date(2020, 1, 1))
