"""Chat formatting by columnar byte assembly.

Turns are dealt by conversation and sorted; each task walks through its sorted turns
in batches. The lengths of a batch's segments (marks, roles, contents) give their
offsets by a running sum, and numpy scatters all bytes into one preallocated buffer,
which becomes an Arrow string column cut at the conversations' borders.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culvert.llm.frames import shuffle_tasks, texts

OPEN, BREAK, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
#: Control strings of common templates; a backslash goes behind the first character,
#: one more than stands there already.
_CONTROL = r"(\||/?s>|/?INST\]|/?SYS>)"
_ESCAPE, _UNESCAPE = rf"([<\[])(\\*){_CONTROL}", re.compile(rf"([<\[])\\(\\*){_CONTROL}")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

#: Bytes of turns above which a conversation goes on in another part.
PART = 16 << 20

LEARNED = "assistant"


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted part."""
    return [
        (unescape(role).replace("%0A", "\n").replace("%25", "%"), unescape(text))
        for role, text in _TURN.findall(formatted)
    ]


def format_chat(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, part, n_turns, formatted, loss)``: conversations as text for training.

    A turn is ``<|im_start|>role``, a line break, its text and ``<|im_end|>`` with a line
    break. ``loss`` lists the spans of ``formatted``, in code points, to learn from:
    the texts of the assistant's turns. Control strings inside roles and texts are
    escaped, so ``read_back`` returns every turn as it was.

    Turns are in order of ``turn``, missing ones first, then of role and text; repeated
    rows are repeated turns. Missing roles and texts are empty, turns without a
    conversation form one. A conversation is one row (part 0); only one longer than
    16 MB goes on in further parts, cut between turns, in order within its partition.
    Other columns are left out; no turns give no rows.
    """
    tasks = shuffle_tasks(turns.sparkSession)
    conv = turns.schema[conv_col].dataType
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, now, part = None, None, 0
        for batch in batches:
            table = batch.select(["conv_id", "role", "text"])
            table = pa.concat_batches([rest, table]) if rest is not None else table
            if not table.num_rows:
                continue
            cuts = _cuts(table)
            out, now, part = _assemble(table.slice(0, cuts[-1]), cuts, now, part) if len(cuts) > 1 else (None, now, part)
            rest = table.slice(cuts[-1])
            if out is not None:
                yield out
        if rest is not None and rest.num_rows:
            yield _assemble(rest, np.array([0, *_cuts(rest)[1:], rest.num_rows]), now, part)[0]

    return ordered.mapInArrow(
        run,
        f"conv_id {conv.simpleString()}, part int, n_turns long, formatted string, loss array<struct<start:long,end:long>>",
    )


def _cuts(table: pa.RecordBatch) -> np.ndarray:
    """Rows at which output rows begin; what follows the last one may go on."""
    at, _ = texts(table.column("text"))
    ids = table.column("conv_id")
    if table.num_rows < 2:
        return np.zeros(1, np.int64)
    same = pc.fill_null(pc.equal(ids.slice(1), ids.slice(0, len(ids) - 1)), False)
    both = pc.and_(ids.slice(1).is_null(), ids.slice(0, len(ids) - 1).is_null())
    starts = np.concatenate([[0], np.flatnonzero(~pc.or_(same, both).to_numpy(zero_copy_only=False)) + 1])
    group = np.searchsorted(starts, np.arange(len(ids)), "right") - 1
    piece = (at[:-1] - at[starts[group]]) // PART
    more = np.flatnonzero((piece[1:] != piece[:-1]) & (group[1:] == group[:-1])) + 1
    return np.union1d(starts, more)


def _assemble(rows: pa.RecordBatch, cuts: np.ndarray, now: object, part: int) -> tuple[pa.RecordBatch, object, int]:
    n = rows.num_rows
    plain = pc.replace_substring(pc.replace_substring(rows.column("role"), "%", "%25"), "\n", "%0A")
    sources = [texts(pc.replace_substring_regex(c, _ESCAPE, r"\1\2\\\3")) for c in (plain, rows.column("text"))]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(BREAK), len(CLOSE)
    lengths[:, 1], lengths[:, 3] = (np.diff(at) for at, _ in sources)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    buffer = np.empty(int(ends[-1, -1]), np.uint8)
    for k, mark in ((0, OPEN), (2, BREAK), (4, CLOSE)):
        buffer[(begins[:, k, None] + np.arange(len(mark))).ravel()] = np.tile(np.frombuffer(mark, np.uint8), n)
    for k, (at, body) in ((1, sources[0]), (3, sources[1])):
        buffer[np.repeat(begins[:, k] - at[:-1], lengths[:, k]) + np.arange(len(body))] = body
    points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
    first, last = cuts[:-1], cuts[1:]
    learned = pc.equal(rows.column("role"), LEARNED).to_numpy(zero_copy_only=False)
    base = np.repeat(points[begins[first, 0]], last - first)
    spans = pa.StructArray.from_arrays(
        [pa.array((points[x[:, 3]] - base)[learned]) for x in (begins, ends)], names=["start", "end"]
    )
    before = np.concatenate([[0], np.cumsum(learned)])
    ids = rows.column("conv_id").take(pa.array(first))
    parts = []
    for value in ids.to_pylist():
        part = part + 1 if now == (value,) else 0
        now = (value,)
        parts.append(part)
    borders = pa.array(np.concatenate([begins[first, 0], [len(buffer)]]), pa.int64())
    formatted = pa.LargeStringArray.from_buffers(len(first), borders.buffers()[1], pa.py_buffer(buffer)).cast(pa.string())
    loss = pa.ListArray.from_arrays(pa.array(np.concatenate([before[first], [before[last[-1]]]]), pa.int32()), spans)
    return (
        pa.RecordBatch.from_arrays(
            [ids, pa.array(parts, pa.int32()), pa.array(last - first), formatted, loss],
            names=["conv_id", "part", "n_turns", "formatted", "loss"],
        ),
        now,
        part,
    )
