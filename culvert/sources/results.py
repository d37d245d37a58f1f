"""Result files of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame, path: str, headers: Mapping[str, str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Writes ``df`` to ``path`` in place of what is there; returns it as written.

    ``headers`` renames columns for the reader of the file.
    """
    out = df.toDF(*[(headers or {}).get(c, c) for c in df.columns])
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported result format: {fmt}")
    return out


def write_result(
    df: DataFrame,
    root: str,
    name: str,
    run_date: dt.date,
    headers: Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> str:
    """Writes ``root/name/run_date=...`` and returns that path.

    A rerun on the same day replaces the output of that day. For several tables that
    belong together see ``Publication``.
    """
    path = f"{root}/{name}/run_date={run_date.isoformat()}"
    write_table(df, path, headers, fmt)
    return path
