"""Line deduplication by winnowing over line hashes.

A text is the sequence of its lines that hold more than white space, each trimmed.
In every window of ``run`` lines the smallest line hash is selected, so any run of
that length in two places has the same fingerprint line selected in both; a line of
``long_line`` words or more is a window of its own. Places with a fingerprint in common
are joined, their matches are extended to both sides in windows, and each line within a
window whose lines also begin earlier (in a row of a smaller id, or before it in the
same text) is deleted.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.llm.frames import ID_KEY, ROW, TEXT_KEY, keyed, packed, stored
from culvert.llm.wordhash import grams, mix

#: White space that does not count in a line.
_BLANK = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words from which a line that repeats alone counts.
LONG_LINE = 8


def _lines(text: str | None) -> tuple[list[str], list[int]]:
    """All lines, and the places of those that count."""
    lines = (text or "").split("\n")
    return lines, [k for k, line in enumerate(lines) if line.strip(_BLANK)]


def _windows(text: str | None, run: int, long_line: int) -> tuple[np.ndarray, ...] | None:
    """For each window: fingerprint, two hashes of all its lines, the number of its
    first line and the number of its lines."""
    lines, places = _lines(text)
    if not places:
        return None
    held = [lines[k].strip(_BLANK) for k in places]
    hashes = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in held], np.uint64)
    alone = np.flatnonzero([len(_WORD.findall(x)) >= long_line for x in held])
    kinds = [(hashes[alone], mix(hashes[alone]), mix(~hashes[alone]), alone, np.ones(len(alone), np.int64))]
    if (n := len(places) - run + 1) > 0:
        least = np.lib.stride_tricks.sliding_window_view(hashes, run).min(axis=1)
        kinds.append((least, grams(hashes, run, 1)[:n], grams(hashes, run, 2)[:n], np.arange(n), np.full(n, run)))
    return tuple(map(np.concatenate, zip(*kinds, strict=True)))


def repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, long_line: int = LONG_LINE
) -> DataFrame:
    """``(_row_id, _row_text, later)``: per text, the windows that also begin earlier, each
    by the number of its first line among those that count and the number of its lines."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(r, w) for r, t in enumerate(batch.column(2)) if (w := _windows(t.as_py(), run, long_line)) is not None]
            if not found:
                continue
            row = np.repeat([r for r, _ in found], [len(w[0]) for _, w in found])
            columns = [np.concatenate([w[k] for _, w in found]) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k).take(pa.array(row)) for k in (0, 1)),
                    *(pa.array(c.view(np.int64)) for c in columns[:3]),
                    *(pa.array(c.astype(np.int32)) for c in columns[3:]),
                ],
                names=[ID_KEY, TEXT_KEY, "mark", "w1", "w2", "start", "size"],
            )

    schema = f"{ID_KEY} long, {TEXT_KEY} long, mark long, w1 long, w2 long, start int, size int"
    windows = stored(keyed(docs, id_col, text_col).mapInArrow(scan, schema), "line-windows")
    place = F.struct(ID_KEY, TEXT_KEY, "start")
    shared = (
        windows.groupBy("mark")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where(F.col("a") != F.col("b"))
        .select("mark")
    )
    # Equal windows have equal marks, so the windows are dealt anew by all their lines:
    # a line that a third of all texts hold does not bring its windows into one task.
    # Both small sides are stored, so Spark can split the rows of a hot key on the other.
    joined = windows.join(stored(shared, "line-marks"), "mark", "left_semi").drop("mark")
    first = joined.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = joined.join(stored(first, "line-firsts"), ["w1", "w2"]).where(place != F.col("first"))
    return later.groupBy(ID_KEY, TEXT_KEY).agg(F.collect_set(F.struct("start", "size")).alias("later"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2, long_line: int = LONG_LINE
) -> DataFrame:
    """``docs`` with the later copies of repeated runs of ``run`` or more lines, and of
    single lines of ``long_line`` or more words, deleted from ``text_col``, and two columns
    more: ``n_lines`` and ``n_removed``. A short line that repeats alone stays.

    Lines of white space only do not count and stay. A text of deleted lines only
    becomes empty; a missing text stays missing, with no lines. Rows with the same id
    and text are one document and are treated alike; rows with the same id and other
    texts, and rows without an id (before all others), are in order of the text's hash.
    """
    found = repeated_windows(docs, id_col, text_col, run, long_line)
    joined = packed(docs, id_col, text_col).join(found, [ID_KEY, TEXT_KEY], "left").select(ROW, "later")
    inputs = docs.columns
    names = [c for c in inputs if c not in ("n_lines", "n_removed")]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(inputs, batch.column(ROW).flatten(), strict=True))
            text, count, gone = [], [], []
            for value, later in zip(columns[text_col].to_pylist(), batch.column("later").to_pylist(), strict=True):
                lines, places = _lines(value)
                drop = {places[k] for w in later or () for k in range(w["start"], w["start"] + w["size"])}
                stay = (k not in drop for k in range(len(lines)))
                text.append("\n".join(itertools.compress(lines, stay)) if drop else value)
                count.append(len(places))
                gone.append(len(drop))
            columns[text_col] = pa.array(text, columns[text_col].type)
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in names), pa.array(count, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, "n_lines", "n_removed"],
            )

    schema = T.StructType(
        [docs.schema[n] for n in names] + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_removed")]
    )
    return joined.mapInArrow(clean, schema)
