"""Substring deduplication with prefix-partitioned suffix trees over words.

A suffix begins at each word; only its first ``WINDOW`` words matter, so the trees
are cut at that depth. A suffix is held as four symbols, 32-bit hashes of its next
four blocks of five words, and a 64-bit hash of all 20 words: windows that share three
of four blocks still differ in it. The work has four steps.

1. Every window's smallest hash of ``GRAM`` words within it is its anchor: equal
   windows have equal anchors. Anchors are dealt by value, and only suffixes whose
   anchor occurs twice can lie below a deep internal node. All others are leaves
   right below the part of the tree that matters, and are not dealt at all.
2. The number of suffixes per prefix is counted over all texts. Frequent prefixes
   are extended by a block of words until a group fits into a task's memory.
3. Suffixes are dealt by prefix. Each task sorts its group, which lists the leaves
   of the group's subtree in order; neighbours equal in all symbols and in the hash of
   all their words share an internal node ``WINDOW`` words deep. Its first leaf stays, the others are repeats.
4. Repeats go back to their texts, and the words that they cover are removed.

A task sends one suffix of those that are equal within it, the first one: the others
are repeats whatever the other tasks hold. So a passage that a third of all texts
share costs one suffix per task and word, and no group grows with its copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.llm.frames import ID_KEY, ROW, TEXT_KEY, keyed, packed, shuffle_tasks, slices, texts
from culvert.llm.wordhash import Words, grams

WINDOW, BLOCK, GRAM = 20, 5, 8
#: Suffixes (and anchors) that a task compares among each other before it sends them.
SCOPE = 1_500_000
#: Suffixes in a group above which its prefix is extended.
GROUP = 2_000_000
#: Prefixes counted: values of so many leading bits of the first symbol.
_CELL_BITS = 12

_LAST = np.uint64(2**64 - 1)
#: A message from task to task: rows of equal length, and the texts they point to.
_POST = "bucket int, kind int, ids binary, hashes binary, which binary, a binary, b binary"


class _Scan:
    """Anchors of all windows of a slice of texts. ``anchor`` and ``ok`` are by word:
    the anchor of the window that begins there, and whether there is one."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(body, offsets)
        self.room = words.room()
        n, span = len(words.hashes), WINDOW - GRAM + 1
        self.gram = np.where(self.room >= GRAM, grams(words.hashes, GRAM, 3), _LAST)
        self.ok = self.room >= WINDOW
        self.anchor = _sliding(np.minimum, self.gram, span, _LAST)
        known = np.where(self.ok, self.anchor, np.uint64(0))
        back = _sliding(np.maximum, known[::-1], span, np.uint64(0))[::-1]
        self.places = np.flatnonzero((back == self.gram) & (self.room >= GRAM)) if n else np.zeros(0, np.int64)


def _sliding(pick: Callable, x: np.ndarray, span: int, pad: np.uint64) -> np.ndarray:
    """``pick`` over the ``span`` values from each on, by doubling."""
    have = 1
    while have < span:
        step = min(have, span - have)
        shifted = np.full(len(x), pad, np.uint64)
        shifted[: max(0, len(x) - step)] = x[step:]
        x, have = pick(x, shifted), have + step
    return x


def _symbols(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The four symbols of each word's suffix, two in each of two numbers, and the hash
    of all its words. Windows that differ in one word's hash always differ in that."""
    top = grams(words.hashes, BLOCK, 4) >> np.uint64(32)

    def symbol(k: int) -> np.ndarray:
        out = np.zeros(len(top), np.uint64)
        out[: max(0, len(top) - k * BLOCK)] = top[k * BLOCK :]
        return out

    return (symbol(0) << np.uint64(32)) | symbol(1), (symbol(2) << np.uint64(32)) | symbol(3), grams(words.hashes, WINDOW, 5)


class _Texts:
    """Texts of a scope in the order seen; entries point to them by number."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.count = 0

    def add(self, ids: np.ndarray, hashes: np.ndarray) -> int:
        self.ids.append(ids)
        self.hashes.append(hashes)
        self.count += len(ids)
        return self.count - len(ids)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.ids), np.concatenate(self.hashes)


def _post(bucket: np.ndarray, kind: int, known: tuple, which: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple]:
    """Entries as one message per bucket, with the texts that they point to."""
    order = np.argsort(bucket, kind="stable")
    bucket, which, a, b = bucket[order], which[order], a[order], b[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(bucket)]):
        if lo < hi:
            used, points = np.unique(which[lo:hi], return_inverse=True)
            yield (
                int(bucket[lo]), kind, known[0][used].tobytes(), known[1][used].tobytes(),
                points.astype(np.uint32).tobytes(), a[lo:hi].tobytes(), b[lo:hi].tobytes(),
            )


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 64) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(itertools.islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), schema.types, strict=True)], schema=schema)


_POST_ARROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), *((n, pa.binary()) for n in ("ids", "hashes", "which", "a", "b"))]
)
_ONE, _SHARED, _KNOWN = 0, 1, 2


def _home(ids: np.ndarray, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a text."""
    return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + hashes.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _read(table: pa.Table, kind: int, a: str, b: str) -> tuple[np.ndarray, ...]:
    """All entries of a kind: id and hash of the text, and both values."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    for row in table.to_pylist():
        if row["kind"] == kind:
            ids, hashes, which = (np.frombuffer(row[n], t) for n, t in (("ids", "<i8"), ("hashes", "<i8"), ("which", "<u4")))
            for to, part in zip(out, (ids[which], hashes[which], np.frombuffer(row["a"], a), np.frombuffer(row["b"], b)), strict=True):
                to.append(part)
    return tuple(np.concatenate(p) if p else np.zeros(0, t) for p, t in zip(out, ("<i8", "<i8", a, b), strict=True))


# --- step 1: anchors ---------------------------------------------------------


def _send_anchors(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, which, value, held = _Texts(), [], [], 0

        def flush() -> Iterator[tuple]:
            w, v = np.concatenate(which), np.concatenate(value)
            ids, hashes = known.arrays()
            order = np.argsort(v, kind="stable")
            s = v[order]
            new = np.concatenate([[True], s[1:] != s[:-1]])
            group = np.cumsum(new) - 1
            # The same row twice is one text: its anchors count once.
            first = np.flatnonzero(new)[group]
            other = (ids[w[order]] != ids[w[order[first]]]) | (hashes[w[order]] != hashes[w[order[first]]])
            same_text_twice = np.zeros(len(s), bool)
            same_text_twice[1:] = (s[1:] == s[:-1]) & (w[order][1:] == w[order][:-1])
            many = (np.bincount(group, other | same_text_twice, minlength=group[-1] + 1) > 0)[group]
            again = np.zeros(len(s), bool)
            again[order] = many
            ones = order[~many & new]
            yield from _post((v[ones] % np.uint64(buckets)).astype(np.int64), _ONE, (ids, hashes), w[ones], v[ones], np.zeros(len(ones), np.uint8))
            told = order[new & many]
            yield from _post((v[told] % np.uint64(buckets)).astype(np.int64), _SHARED, (ids, hashes), w[told], v[told], np.zeros(len(told), np.uint8))
            keep = np.flatnonzero(again)
            keep = keep[np.unique(np.stack([w[keep].astype(np.uint64), v[keep]]), axis=1, return_index=True)[1]] if len(keep) else keep
            yield from _post(_home(ids, hashes, buckets)[w[keep]], _KNOWN, (ids, hashes), w[keep], v[keep], np.zeros(len(keep), np.uint8))

        for batch in batches:
            offsets, body = texts(batch.column(2))
            ids, hashes = (batch.column(k).to_numpy() for k in (0, 1))
            for lo, hi in slices(offsets):
                scan = _Scan(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                base = known.add(ids[lo:hi], hashes[lo:hi])
                which.append(base + scan.words.text_of()[scan.places])
                value.append(scan.gram[scan.places])
                held += len(scan.places)
                if held >= SCOPE:
                    yield from _batches(flush(), _POST_ARROW)
                    known, which, value, held = _Texts(), [], [], 0
        if held:
            yield from _batches(flush(), _POST_ARROW)

    return run


def _match_anchors(buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        ids, hashes, value, _ = _read(table, _ONE, "<u8", "u1")
        shared = _read(table, _SHARED, "<u8", "u1")[2]
        order = np.lexsort((hashes, ids, value))
        v, i, h = value[order], ids[order], hashes[order]
        new = np.ones(len(v), bool)
        new[1:] = v[1:] != v[:-1]
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)[group]
        other = (i != i[first]) | (h != h[first])
        many = (np.bincount(group, other) > 0)[group] if len(v) else new
        twice = order[many | np.isin(v, shared)]
        out = list(_replies(ids[twice], hashes[twice], value[twice], buckets))
        for row in table.to_pylist():
            if row["kind"] == _KNOWN:
                out.append(tuple(row.values()))
        return _table(out)

    return run


def _replies(ids: np.ndarray, hashes: np.ndarray, a: np.ndarray, buckets: int) -> Iterator[tuple]:
    pairs, which = np.unique(np.stack([ids, hashes]), axis=1, return_inverse=True)
    which = which.ravel()
    yield from _post(_home(ids, hashes, buckets), _KNOWN, (pairs[0], pairs[1]), which, a, np.zeros(len(a), np.uint8))


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(_POST_ARROW)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _POST_ARROW.types, strict=True)], schema=_POST_ARROW)


def _per_text(pack: str, spans: bool) -> Callable:
    """Messages of a bucket of texts as one row per text; ``spans`` turns places into
    runs of neighbouring ones."""

    def run(table: pa.Table) -> pa.Table:
        ids, hashes, value, length = _read(table, _KNOWN, pack, "<u4" if spans else "u1")
        order = np.lexsort((value, hashes, ids))
        ids, hashes, value, length = ids[order], hashes[order], value[order], length[order]
        cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(hashes) != 0)) + 1
        rows = []
        for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(ids)]):
            if lo < hi:
                part = np.stack([value[lo:hi], length[lo:hi]], axis=1) if spans else np.unique(value[lo:hi])
                rows.append((int(ids[lo]), int(hashes[lo]), part.tobytes()))
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=[ID_KEY, TEXT_KEY, "note"])

    return run


# --- step 2: prefixes --------------------------------------------------------


def prefix_blocks(docs: DataFrame, group: int = GROUP) -> np.ndarray:
    """For each cell of prefixes, the blocks of words by which its suffixes are dealt:
    one, or more where a cell holds more than ``group`` suffixes. Counts all texts;
    the driver gets one number per cell, of a fixed number of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _CELL_BITS, np.int64)
        for batch in batches:
            offsets, body = texts(batch.column(0))
            for lo, hi in slices(offsets):
                words = Words(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                block = grams(words.hashes, BLOCK, 4)[words.room() >= WINDOW]
                counts += np.bincount((block >> np.uint64(64 - _CELL_BITS)).astype(np.int64), minlength=len(counts))
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "n"])

    counted = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    blocks = np.ones(1 << _CELL_BITS, np.uint8)
    for cell, n in counted.where(F.col("n") > group).collect():
        blocks[cell] = min(WINDOW // BLOCK, 1 + int(np.ceil(np.log2(n / group))))
    return blocks


def _groups(a: np.ndarray, b: np.ndarray, blocks: np.ndarray, buckets: int) -> np.ndarray:
    """Group of each suffix by its prefix of one to four blocks."""
    depth = blocks[(a >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]
    prefix = np.where(depth == 1, a >> np.uint64(32), a)
    low = np.where(depth == 3, b >> np.uint64(32), np.where(depth > 3, b, np.uint64(0)))
    mixed = (prefix * np.uint64(0x9E3779B97F4A7C15)) ^ (low * np.uint64(0xD6E8FEB86659FD93))
    return ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


# --- step 3: suffixes --------------------------------------------------------


def deep_nodes(a: np.ndarray, b: np.ndarray, c: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For suffixes in sorted ``order``: the first leaf of the node, ``WINDOW`` words
    deep, under which each lies (its own place if no other leaf does)."""
    s, t, u = a[order], b[order], c[order]
    new = np.ones(len(order), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1]) | (u[1:] != u[:-1])  # the common prefix with the leaf before ends earlier
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _repeats(a, b, c, ids, hashes, place) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the suffixes that a subtree keeps, and of the repeats."""
    order = np.lexsort((place, hashes, ids, c, b, a))
    first = order[deep_nodes(a, b, c, order)]
    later = (ids[order] != ids[first]) | (hashes[order] != hashes[first]) | (place[order] != place[first])
    kept = np.unique(first)
    return kept, order[later]


def _runs(which: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring places of a text as (text, first place, number)."""
    order = np.lexsort((place, which))
    w, p = which[order], place[order].astype(np.int64)
    if not len(w):
        return w, p.astype(np.uint32), p.astype(np.uint32)
    cut = np.concatenate([[True], (w[1:] != w[:-1]) | (p[1:] > p[:-1] + 1)])
    at = np.flatnonzero(cut)
    last = np.concatenate([at[1:] - 1, [len(w) - 1]])
    return w[at], p[at].astype(np.uint32), (p[last] - p[at] + 1).astype(np.uint32)


_SUFFIX = np.dtype([("a", "<u8"), ("b", "<u8"), ("c", "<u8")])


def _send_suffixes(at_text: int, blocks: np.ndarray, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _Texts(), 0
        parts: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[tuple]:
            which, place, a, b, c = (np.concatenate(p) for p in zip(*parts, strict=True))
            ids, hashes = known.arrays()
            kept, later = _repeats(a, b, c, ids[which], hashes[which], place)
            symbols = np.empty(len(kept), _SUFFIX)
            symbols["a"], symbols["b"], symbols["c"] = a[kept], b[kept], c[kept]
            yield from _post(_groups(a[kept], b[kept], blocks, buckets), _ONE, (ids, hashes), which[kept], symbols, place[kept])
            w, p, n = _runs(which[later], place[later])
            yield from _post(_home(ids, hashes, buckets)[w], _KNOWN, (ids, hashes), w, p, n)

        for batch in batches:
            offsets, body = texts(batch.column(ROW).flatten()[at_text])
            ids, hashes = (batch.column(c).to_numpy() for c in (ID_KEY, TEXT_KEY))
            note_at, notes = texts(batch.column("note"))
            for lo, hi in slices(offsets):
                if note_at[lo] == note_at[hi]:
                    continue
                scan = _Scan(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                words = scan.words
                alive = np.zeros(len(words.hashes), bool)
                for r in range(lo, hi):
                    if note_at[r] < note_at[r + 1]:
                        s, e = words.first[r - lo], words.first[r - lo + 1]
                        alive[s:e] = np.isin(scan.anchor[s:e], np.frombuffer(notes[note_at[r] : note_at[r + 1]].tobytes(), "<u8"))
                at = np.flatnonzero(alive & scan.ok)
                a, b, c = _symbols(words)
                text = words.text_of()[at]
                parts.append((known.add(ids[lo:hi], hashes[lo:hi]) + text, (at - words.first[text]).astype(np.uint32), a[at], b[at], c[at]))
                held += len(at)
                if held >= SCOPE:
                    yield from _batches(flush(), _POST_ARROW)
                    known, held, parts = _Texts(), 0, []
        if held:
            yield from _batches(flush(), _POST_ARROW)

    return run


def _match_suffixes(buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        ids, hashes, symbols, place = _read(table, _ONE, _SUFFIX, "<u4")
        _, later = _repeats(symbols["a"], symbols["b"], symbols["c"], ids, hashes, place)
        pairs, which = np.unique(np.stack([ids[later], hashes[later]]), axis=1, return_inverse=True)
        w, p, n = _runs(which.ravel(), place[later])
        out = list(_post(_home(pairs[0], pairs[1], buckets)[w], _KNOWN, (pairs[0], pairs[1]), w, p, n))
        for row in table.to_pylist():
            if row["kind"] == _KNOWN:
                out.append(tuple(row.values()))
        return _table(out)

    return run


# --- step 4: texts -----------------------------------------------------------


def _cut(text: str | None, note: bytes | None) -> tuple[str, int, int]:
    words = (text or "").encode().split()
    gone = 0
    if note:
        edge = np.zeros(len(words) + 1, np.int64)
        for place, count in np.frombuffer(note, "<u4").reshape(-1, 2).tolist():
            edge[place] += 1
            edge[place + count + WINDOW - 1] -= 1
        stay = np.cumsum(edge)[:-1] == 0
        gone = len(words) - int(stay.sum())
        return b" ".join(itertools.compress(words, stay.tolist())).decode(), len(words), gone
    return b" ".join(words).decode(), len(words), gone


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` cut down to the words that stay, joined by one space,
    and two columns more: ``n_words`` and ``n_removed``.

    Words are parted by ASCII white space and compared as they are. A word goes if a
    window of 20 words that covers it also begins earlier: in a row of a smaller id, or
    before it in the same text. Windows are judged on the input. Missing and blank
    texts become empty, with no words. Rows with the same id and text are one document
    and are treated alike; rows with the same id and other texts, and rows without an
    id (before all others), are in order of the text's hash.
    """
    buckets = shuffle_tasks(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    blocks = prefix_blocks(rows)
    notes = f"{ID_KEY} long, {TEXT_KEY} long, note binary"

    def dealt(posts: DataFrame, match: Callable) -> DataFrame:
        return posts.groupBy("bucket").applyInArrow(match, _POST)

    anchors = dealt(rows.mapInArrow(_send_anchors(buckets), _POST), _match_anchors(buckets))
    shared = anchors.groupBy("bucket").applyInArrow(_per_text("<u8", False), notes)
    # Both joins read the same columns of the texts, so they are dealt by key once.
    marked = packed(docs, id_col, text_col)
    inputs = docs.columns
    asked = marked.join(shared, [ID_KEY, TEXT_KEY])
    sent = asked.mapInArrow(_send_suffixes(inputs.index(text_col), blocks, buckets), _POST)
    repeats = dealt(sent, _match_suffixes(buckets)).groupBy("bucket").applyInArrow(_per_text("<u4", True), notes)
    joined = marked.join(repeats, [ID_KEY, TEXT_KEY], "left").select(ROW, "note")
    names = [c for c in inputs if c not in ("n_words", "n_removed")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(inputs, batch.column(ROW).flatten(), strict=True))
            pairs = zip(columns[text_col].to_pylist(), batch.column("note").to_pylist(), strict=True)
            text, count, gone = zip(*(_cut(t, n) for t, n in pairs), strict=True) if batch.num_rows else ((), (), ())
            columns[text_col] = pa.array(text, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in names), pa.array(count, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, "n_words", "n_removed"],
            )

    schema = T.StructType(
        [T.StructField(n, T.StringType()) if n == text_col else docs.schema[n] for n in names]
        + [T.StructField(n, T.LongType()) for n in ("n_words", "n_removed")]
    )
    return joined.mapInArrow(cut, schema)
