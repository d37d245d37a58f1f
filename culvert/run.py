"""A whole run: load feeds or a snapshot, screen, write the report.

    spark-submit --py-files culvert.zip culvert/run.py \\
        --landing /data/landing --local /data/local \\
        --snapshots /data/snapshots --output /data/outputs [--snapshot 2026-04-13]

With ``--snapshot`` the five public feeds come from that day's snapshot and the
run fails when there is none; without it they are read from the landing folder
(tab-delimited text) and kept as today's snapshot first. The facility list and
the enforcement orders are local files in both cases. Snapshots and results are
published whole: a run that breaks off leaves those of earlier runs as they were.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from culvert.config import ScreeningConfig
from culvert.operators.layout import audit
from culvert.plans import RESULT_HEADERS, Screening, screen, summary
from culvert.sources import STAGED, Publication, read_delimited, read_published, stage

LOCAL = ("facilities", "enforcement")


def load(
    spark: SparkSession,
    landing: str,
    local: str,
    snapshots: str,
    snapshot: dt.date | None = None,
    today: dt.date | None = None,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """Staged tables from a snapshot, or from fresh feeds that become one."""
    day = snapshot or today or dt.date.today()
    public = {name: feed for name, feed in STAGED.items() if name not in LOCAL}
    if snapshot is None:
        with Publication(spark, snapshots, day) as kept:
            for feed in public.values():
                path = f"{landing}/{feed.stem}.txt"
                fresh = read_delimited(spark, path, sep="\t", tokens=feed.tokens, upper=feed.upper, multiline=multiline)
                kept.add(feed.stem, fresh)
    tables = {}
    for name, feed in STAGED.items():
        if name in public:
            # Fresh feeds are read back too: later passes then scan columns, not text.
            raw = read_published(spark, snapshots, feed.stem, day)
        else:
            raw = read_delimited(spark, f"{local}/{feed.stem}.csv", tokens=feed.tokens, multiline=multiline)
        tables[name] = stage(raw, feed.columns)
    return tables


def publish(
    run: Screening, root: str, day: dt.date, fmt: str = "csv", tables: Mapping[str, DataFrame] | None = None
) -> dict[str, str]:
    """Publishes the report, the assets under enforcement, the summary and the
    audit of a run, all at once; returns their paths (``read_published`` reads them). The
    audit lists the raw ``tables`` too, the spill feeds from the run's own counts."""
    report = run.report.persist()  # read by the file, the summary and the audit
    under = run.under_enforcement.persist()
    raw = {f"raw_{n}": t.select("wdid") for n, t in (tables or {}).items() if not n.endswith("_spills")}
    counts = {n: df for n, df in run.stages.items() if "n" in df.columns}
    stages = raw | {n: df for n, df in run.stages.items() if n not in counts} | {
        "attributes": run.attributes,
        "rates_5yr": run.rates_5yr,
        "rates_12mo": run.rates_12mo,
        "low_both": run.low_both,
        "reporting_gaps": run.reporting_gaps,
        "active_orders": run.active_orders,
        "under_enforcement": under,
        "report": report,
    }
    with Publication(report.sparkSession, root, day) as out:
        paths = {
            "report": out.add("report", report, RESULT_HEADERS, fmt),
            "under_enforcement": out.add("under_enforcement", under, RESULT_HEADERS, fmt),
            "summary": out.add("summary", summary(report), fmt=fmt),
            "audit": out.add("audit", audit(stages, "wdid", counts), fmt=fmt),
        }
    for df in (report, under):
        df.unpersist()
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--landing", default="landing")
    p.add_argument("--local", default="local")
    p.add_argument("--snapshots", default="snapshots")
    p.add_argument("--snapshot", type=dt.date.fromisoformat)
    p.add_argument("--output", default="outputs")
    p.add_argument("--start", type=dt.date.fromisoformat, default=ScreeningConfig.analysis_start)
    p.add_argument("--end", type=dt.date.fromisoformat, default=ScreeningConfig.analysis_end)
    p.add_argument("--format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--one-line-records", action="store_true", help="split large feed files")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("screening").getOrCreate()
    day = dt.date.today()
    tables = load(
        spark,
        args.landing,
        args.local,
        args.snapshots,
        args.snapshot,
        day,
        multiline=not args.one_line_records,
    )
    run = screen(tables, ScreeningConfig(analysis_start=args.start, analysis_end=args.end))
    for path in publish(run, args.output, day, args.format, tables).values():
        print(path)
    run.release()


if __name__ == "__main__":
    main()
