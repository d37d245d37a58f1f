"""Dated snapshots: one Parquet folder per table, partitioned by day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "snapshot_date"


def write_snapshot(df: DataFrame, root: str, table: str, day: dt.date) -> None:
    """Stores ``df`` as the snapshot of ``day``; a second write replaces it.

    Only the partition of that day is overwritten, other days stay.
    """
    (
        df.withColumn(PARTITION, F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(f"{root}/{table}")
    )


def read_snapshot(spark: SparkSession, root: str, table: str, day: dt.date) -> DataFrame:
    """The table as of the snapshot of ``day``; fails when there is none.

    Only the folder of that day is listed and read.
    """
    base = f"{root}/{table}"
    try:
        return (
            spark.read.option("basePath", base)
            .parquet(f"{base}/{PARTITION}={day.isoformat()}")
            .drop(PARTITION)
        )
    except AnalysisException as e:
        raise FileNotFoundError(f"no snapshot of {table} for {day} under {root}") from e


def as_of(df: DataFrame, day: dt.date, column: str = PARTITION) -> DataFrame:
    """Rows of one snapshot of a table that carries its snapshot day."""
    return df.where(F.col(column) == F.lit(day)).drop(column)
