"""Records of delimited files whose quoted fields may hold line breaks, read in parallel.

A task that begins in the middle of a file cannot know whether it begins inside a
quoted field, and so which line breaks end a record. Each split is therefore read
once under both assumptions: for every line it is noted whether it begins and ends
inside a field, and how many records have begun so far, if the split begins outside
or inside. What a split makes of either assumption is one small row; chaining these
rows file by file gives each split its true beginning and the number of records
before it. With them each stored line knows its record, and only the lines of
records that span several lines are brought together.

Lines are stored once and everything follows from the stored lines: however a later
scan divides its input, no line can lose its place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from culvert.operators.cut import written

_QUOTE = '"'
_SPLIT = ["_file", "_start"]
_LINES = "_file string, _start long, _at long, value string, open0 boolean, shut0 boolean, begun0 long, open1 boolean, shut1 boolean, begun1 long"
_CHAINED = "_file string, _start long, inside boolean, before long, spans boolean, total long, unclosed boolean"


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """Does the line end inside a quoted field? A field is quoted if it begins with a
    quote; two quotes in a quoted field stand for one."""
    at = 0
    if not inside and line.startswith(_QUOTE):
        at, inside = 1, True
    while True:
        if inside:
            at = line.find(_QUOTE, at)
            while at >= 0 and line.startswith(_QUOTE, at + 1):
                at = line.find(_QUOTE, at + 2)
            if at < 0:
                return True
            at += 1
        found = line.find(sep + _QUOTE, at)
        if found < 0:
            return False
        at, inside = found + len(sep) + 1, True


class _Hypothesis:
    """The lines of a split in order, if it begins inside a quoted field or not."""

    def __init__(self, inside: bool) -> None:
        self.inside, self.begun = inside, 0

    def step(self, blank: np.ndarray, quoted: np.ndarray, ends: list[tuple[bool, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        after = [self.inside]
        for outside_end, inside_end in ends:
            after.append(inside_end if after[-1] else outside_end)
        states, lines = np.array(after), np.arange(len(blank))
        opened = states[np.searchsorted(quoted, lines, "left")]
        shut = states[np.searchsorted(quoted, lines, "right")]
        begun = self.begun + np.cumsum(~opened & ~blank)
        if len(lines):
            self.inside, self.begun = bool(shut[-1]), int(begun[-1])
        return opened, shut, begun


def _annotated(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, hypotheses = None, 0, ()
        for batch in batches:
            files, starts = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
            code = files.indices.to_numpy()
            change = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                split = (part.column(0)[0].as_py(), part.column(1)[0].as_py())
                if split != here:
                    here, at, hypotheses = split, 0, (_Hypothesis(False), _Hypothesis(True))
                values = part.column(2)
                quoted = np.flatnonzero(pa.compute.match_substring(values, _QUOTE).to_numpy(zero_copy_only=False))
                blank = pa.compute.is_in(values, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
                ends = [(ends_inside(v, sep, False), ends_inside(v, sep, True)) for v in values.take(pa.array(quoted)).to_pylist()]
                noted = [pa.array(x) for h in hypotheses for x in h.step(blank, quoted, ends)]
                place = pa.array(np.arange(at, at + part.num_rows))
                at += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), place, values, *noted],
                    ["_file", "_start", "_at", "value", "open0", "shut0", "begun0", "open1", "shut1", "begun1"],
                )

    return run


def _chain(splits: pa.Table) -> pa.Table:
    """The splits of one file: does each begin inside a field, and after how many records?"""
    rows = splits.sort_by("_start").to_pylist()
    inside, before, out = False, 0, []
    for r in rows:
        now = r["last1"] if inside else r["last0"]
        out.append({"_file": r["_file"], "_start": r["_start"], "inside": inside, "before": before, "spans": now["spans"]})
        inside, before = now["shut"], before + now["begun"]
    for r in out:
        r |= {"total": before, "unclosed": inside}
    return pa.Table.from_pylist(out)


def read_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``(_file, ordinal, row_no, record)``: the records of all files below ``path``.

    ``ordinal`` counts the records of a file from 0, its header; ``row_no`` is the place
    in the feed (files by name) without the headers, NULL for these. Blank lines between
    records are left out, a byte order mark and the carriage return that ends a record
    are cut off. A quoted field that a file leaves open is refused, with the file's name.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    placed = text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), "value")
    lines = written(placed.mapInArrow(_annotated(sep), _LINES), "lines")

    def last(k: int) -> Column:
        """The split's end, and whether any line belongs to a longer record."""
        end = F.max_by(F.struct(f"shut{k}", f"begun{k}"), "_at")
        spans = F.bool_or(F.col(f"open{k}") | F.col(f"shut{k}"))
        return F.struct(end[f"shut{k}"].alias("shut"), end[f"begun{k}"].alias("begun"), spans.alias("spans")).alias(f"last{k}")

    per_split = lines.groupBy(*_SPLIT).agg(last(0), last(1))  # one row per split of the feed
    chained = per_split.groupBy("_file").applyInArrow(_chain, _CHAINED)
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = chained.groupBy("_file").agg((F.max("total") - 1).alias("rows"))
    firsts = files.select("_file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"))
    splits = written(chained.join(firsts, "_file"), "splits")
    seen = splits.agg(F.bool_or("spans").alias("spans"), F.min(F.when(F.col("unclosed"), F.col("_file"))).alias("broken")).first()
    if seen.broken:
        raise ValueError(f"a quoted field is left open in {seen.broken}")

    def of(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    known = lines.join(splits.select(*_SPLIT, "inside", "before", "first"), _SPLIT).select(
        "_file", "first", "_start", "_at", "value", of("open").alias("open"), of("shut").alias("shut"),
        (F.col("before") + of("begun") - 1).alias("ordinal"),
    )
    # Also in the value itself: a caller's filter, moved down, must not see part of a record.
    sole = F.expr("NOT open AND NOT shut AND value NOT IN ('', '\r')")
    whole = known.where(sole).select("_file", "first", "ordinal", F.when(sole, F.col("value")).alias("value"))
    if seen.spans:
        parts = known.where("open OR shut").groupBy("_file", "first", "ordinal")
        joined = parts.agg(F.array_sort(F.collect_list(F.struct("_start", "_at", "value"))).alias("p"))
        whole = whole.unionByName(joined.select("_file", "first", "ordinal", F.array_join("p.value", "\n").alias("value")))
    bare = F.regexp_replace("value", r"\r\z", "")
    bare = F.when(F.col("ordinal") == 0, F.regexp_replace(bare, "^\ufeff", "")).otherwise(bare)
    row_no = F.when(F.col("ordinal") > 0, F.col("first") + F.col("ordinal") - 1).alias("row_no")
    return whole.select("_file", "ordinal", row_no, bare.alias("record"))
