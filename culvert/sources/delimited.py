"""Delimited text as string columns with safe headers and a line order."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.functions import null_tokens
from culvert.operators.cut import written
from culvert.sources.records import read_records

# Never in the data: keeps the reader from making its own NULLs of "NA".
_NO_TOKEN = "\u0001"
_MARK = "\ufeff"


def normalise_headers(names: Sequence[str], upper: bool = False, mangle: bool = True) -> list[str]:
    """Header names as the rest of the job expects them.

    Characters other than letters, digits, ``_`` and ``.`` become ``.``, a name
    that starts badly gets an ``X``, and repeats are numbered ``A, A.1, A.2``.
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    for raw in names:
        name = raw
        if mangle:
            name = re.sub(r"[^0-9A-Za-z_.]", ".", name.strip())
            if not re.match(r"[A-Za-z]|\.(?![0-9])", name):
                name = "X" + name
        if upper:
            name = name.upper()
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(name if n == 0 else f"{name}.{n}")
    return out


def _fields(line: str, sep: str) -> list[str]:
    return next(csv.reader([line.removeprefix(_MARK)], delimiter=sep))


def _agreed(path: str, headers: Sequence[tuple[str, str]], sep: str) -> list[str]:
    """Field names from the files' headers (text, file), which must agree."""
    if not headers:
        raise ValueError(f"no header line in {path}")
    names = _fields(headers[0][0], sep)
    for text, file in headers[1:]:
        if _fields(text, sep) != names:
            raise ValueError(f"the header of {file} differs from the feed's")
    return names


def _header(spark: SparkSession, path: str, sep: str) -> tuple[list[str], bool]:
    """Header of a feed of one-line records, and whether the reader can hold all files
    against it: it can't if names repeat or a byte order mark precedes them. Then all
    lines are read for the first ones of the files, which must agree."""
    lines = spark.read.text(path)
    some = lines.limit(1).collect()
    names = _agreed(path, [(r.value, path) for r in some], sep)
    if len({n.lower() for n in names}) == len(names) and not some[0].value.startswith(_MARK):
        return names, True
    placed = lines.select(
        "value",
        F.input_file_name().alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    first = placed.where("_start = 0").groupBy("_file").agg(F.min_by("value", "_at").alias("value"))
    bare = F.regexp_replace("value", f"^{_MARK}", "")
    found = first.groupBy(bare.alias("value")).agg(F.min("_file").alias("_file")).limit(3).collect()
    return _agreed(path, [(some[0].value, path), *((r.value, r._file) for r in found)], sep), False


def _with_row_no(df: DataFrame) -> DataFrame:
    """``row_no``: position in the feed (files by name, lines in order), from 0.

    A split's lines are neighbours in one task, so a line's place in its split is
    its distance from the split's first one. The lines of earlier splits, from a
    count per split, come on top; only that list is sorted. Both sides read the same
    stored lines: two scans of the feed might split it differently.
    """
    split = ["_file", "_start"]
    placed = written(
        df.select(
            "*",
            F.input_file_name().alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "lines",
    )
    counted = placed.groupBy(*split).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        *split, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    return (
        placed.join(offsets, split)
        .withColumn("row_no", F.col("_at") + F.col("_offset"))
        .drop(*split, "_at", "_offset")
    )


def _one_line_records(spark: SparkSession, path: str, sep: str, upper: bool, mangle: bool) -> DataFrame:
    header, checked = _header(spark, path, sep)
    names = normalise_headers(header, upper, mangle)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (header if checked else names)])
    raw = spark.read.schema(schema).options(header=True, enforceSchema=not checked, **_options(sep)).csv(path)
    return _with_row_no(raw.toDF(*names))


def _spanning_records(spark: SparkSession, path: str, sep: str, upper: bool, mangle: bool) -> DataFrame:
    records = read_records(spark, path, sep)
    headers = records.where("ordinal = 0").groupBy("record").agg(F.min("_file").alias("_file"))
    found = sorted((r._file, r.record) for r in headers.limit(3).collect())
    names = normalise_headers(_agreed(path, [(text, file) for file, text in found], sep), upper, mangle)
    # By place, as names may repeat or differ in case only.
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _options(sep).items()}
    row = F.when(F.col("ordinal") > 0, F.col("record"))
    fields = F.from_csv(row, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {**options, "multiLine": "true"})
    number = F.when(row.isNotNull(), F.col("row_no")).alias("row_no")
    parsed = records.where("ordinal > 0").select(fields.alias("f"), number)
    return parsed.select(*[F.col("f")[f"c{k}"].alias(f"c{k}") for k in range(len(names))], "row_no").toDF(*names, "row_no")


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "nullValue": _NO_TOKEN}


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    tokens: Sequence[str] = ("NA",),
    upper: bool = False,
    mangle: bool = True,
    multiline: bool = True,
) -> DataFrame:
    """All columns as text plus ``row_no``.

    Headers come from the first record of the files, which must agree, and are fixed
    by position, so repeated names survive. ``multiline`` allows line breaks in quoted
    fields, headers included; large files are read in parallel either way. Turning it
    off spares feeds known to have none the search for them. The lines are stored once
    in the shared folder.
    """
    read = _spanning_records if multiline else _one_line_records
    ordered = read(spark, path, sep, upper, mangle)
    # No number, no record: what is none has no values either, not even blank ones.
    real = F.col("row_no").isNotNull()
    return ordered.select(
        *[F.when(real, null_tokens(F.col(f"`{n}`"), tuple(tokens))).alias(n) for n in ordered.columns if n != "row_no"], "row_no"
    )
