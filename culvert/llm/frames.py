"""Small helpers shared by the operators: row keys, stored tables, Arrow texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.operators.cut import written as stored

__all__ = [
    "ID_KEY", "NO_ID", "ROW", "TEXT_KEY", "keyed", "packed", "row_key", "shuffle_tasks", "slices", "stored", "texts", "unpacked",
]

#: Stands for a missing id in row keys; such rows sort before all others.
NO_ID = -(2**63)

#: Keys that a text operator adds to its rows for as long as it runs.
ID_KEY, TEXT_KEY = "_row_id", "_row_text"
ROW = "_row"


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns with a key that tells rows of the same id and other texts
    apart. Rows equal in both are one document to the operators."""
    return df.select(*row_key(df, id_col, text_col), F.col(text_col).alias("text"))


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The key, and the row as one struct: no name of its columns can clash with those
    that an operator adds."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)
    return df.select(*row_key(df, id_col, text_col), whole)


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(ROW)[n].alias(n) for n in names])


def row_key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [
        F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)).alias(ID_KEY),
        F.xxhash64(F.coalesce(df[text_col], F.lit(""))).alias(TEXT_KEY),
    ]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; missing values are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at.astype(np.int64) - at[0], body[at[0] : at[-1]]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one longer text."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, min(to, rows)
        row = to
