"""Results of a run that readers see all at once or not at all.

A run writes its tables into a folder of its own and then, as its last step, one
manifest: a row per table with its place. Readers follow the newest manifest, so a run
that ends between two writes changes nothing for them, and a second run on a day takes
the place of the first without touching files that somebody may be reading.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.sources.results import write_table

_MANIFESTS, _RUNS = "_manifests", "_runs"
_ROWS = T.StructType(
    [
        T.StructField("run_date", T.DateType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("committed", T.TimestampType()),
        T.StructField("name", T.StringType()),
        T.StructField("place", T.StringType()),
        T.StructField("fmt", T.StringType()),
        T.StructField("schema", T.StringType()),
    ]
)


class Publication:
    """The tables of one run below ``root``; nothing is visible before ``commit``.

    ``with Publication(spark, root, day) as run: run.add("report", df)`` commits at its
    end, unless an error ends it.
    """

    def __init__(self, spark: SparkSession, root: str, run_date: dt.date) -> None:
        self.spark, self.root, self.run_date = spark, root.rstrip("/"), run_date
        self.run_id = uuid.uuid4().hex
        self.tables: dict[str, tuple[str, str, str]] = {}
        self.committed = False

    def add(self, name: str, df: DataFrame, headers: Mapping[str, str] | None = None, fmt: str = "parquet") -> str:
        """Writes a table of the run and returns its path; ``headers`` renames columns."""
        if self.committed or name in self.tables:
            raise ValueError(f"{name}: the run is committed or has such a table already")
        place = f"{_RUNS}/run_date={self.run_date.isoformat()}/{self.run_id}/{name}"
        out = write_table(df, f"{self.root}/{place}", headers, fmt)
        self.tables[name] = (place, fmt, out.schema.json())
        return f"{self.root}/{place}"

    def commit(self) -> None:
        """Makes all tables of the run the ones that readers get. One file is written,
        and a file system shows a file whole or not at all."""
        if self.committed:
            raise ValueError("the run is committed already")
        now = dt.datetime.now(dt.timezone.utc)
        rows = [(self.run_date, self.run_id, now, name, *where) for name, where in sorted(self.tables.items())]
        self.spark.createDataFrame(rows, _ROWS).coalesce(1).write.mode("append").parquet(f"{self.root}/{_MANIFESTS}")
        self.committed = True

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *_: object) -> None:
        if kind is None and not self.committed:
            self.commit()


def published(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed table and run day, of the newest run of that day:
    ``run_date, run_id, committed, name, place, fmt, schema``."""
    try:
        manifests = spark.read.schema(_ROWS).parquet(f"{root.rstrip('/')}/{_MANIFESTS}")
    except AnalysisException:
        return spark.createDataFrame([], _ROWS)
    newest = manifests.groupBy("run_date").agg(F.max(F.struct("committed", "run_id")).alias("newest"))
    of_run = newest.select("run_date", "newest.run_id")
    return manifests.join(of_run, ["run_date", "run_id"]).select(*_ROWS.names)


def read_published(spark: SparkSession, root: str, name: str, run_date: dt.date | None = None) -> DataFrame:
    """A table of the newest committed run, or of the newest one of ``run_date``; fails
    when that run has no such table."""
    there = published(spark, root)
    if run_date is None:
        there = there.join(there.agg(F.max("run_date").alias("run_date")), "run_date")
    else:
        there = there.where(F.col("run_date") == F.lit(run_date))
    found = there.where(F.col("name") == name).collect()
    if not found:
        raise FileNotFoundError(f"no published {name} under {root}" + (f" for {run_date}" if run_date else ""))
    row = found[0]
    reader = spark.read.schema(T.StructType.fromJson(json.loads(row.schema)))
    if row.fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.format(row.fmt).load(f"{root.rstrip('/')}/{row.place}")
