"""SimHash near-duplicates: 64-bit fingerprints compared exactly, tile by tile.

``fingerprints`` makes one fingerprint per text. ``links`` compares the distinct
fingerprints: they are sorted into tiles by the population counts of their four
16-bit quarters, and since the counts of two fingerprints differ by no more than
the fingerprints themselves, a pair of tiles whose counts differ by more than the
radius in all is skipped. Each remaining pair of tiles is compared with exclusive-or
and bit counts in numpy. A pair of tiles returns a star per group of linked
fingerprints rather than all pairs, which leaves the components as they are.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culvert.llm.components import components
from culvert.llm.frames import ID_KEY, TEXT_KEY, packed, row_key, stored, texts, unpacked

QUARTERS = 4
#: Fingerprints in a tile, at most about 1.2 times as many.
TILE = 2048
#: Bits in a count of 16 bits, with room for neighbours below 0.
_STEP = 32

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of one text in UTF-8; 0 for a text without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - shingle + 1)
    spans = zip(starts[:count].tolist(), ends[len(words) - count :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    while part := [digest(joined[a:b], 42) for a, b in itertools.islice(spans, 1 << 14)]:
        bits = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, _row_id, _row_text, fp)``, one row per row of ``docs``; ``fp`` holds the 64
    bits as a long.

    Words are parted by ASCII white space, A-Z is lower-cased, and a bit is set if it
    is set in over half of the word shingles' XXH64. Shorter texts have one shingle;
    missing, empty and blank texts have fingerprint 0. Ids may repeat or be missing;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, body = texts(batch.column(3))
            raw = body.tobytes()
            found = np.array(
                [fingerprint(raw[a:b], shingle) for a, b in itertools.pairwise(offsets.tolist())], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(found.view(np.int64))], ["id", ID_KEY, TEXT_KEY, "fp"]
            )

    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType)] + [T.StructField(n, T.LongType()) for n in (ID_KEY, TEXT_KEY, "fp")]
    )
    return docs.select(docs[id_col], *row_key(docs, id_col, text_col), docs[text_col].cast("string")).mapInArrow(run, schema)


def _near(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that sum up to ``radius`` at most; of two opposite ones, one."""
    every = itertools.product(range(-radius, radius + 1), repeat=QUARTERS)
    return [d for d in every if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]


def _cell(counts: list[Column]) -> Column:
    code = F.lit(0)
    for c in counts:
        code = code * _STEP + c
    return code.cast("int")


def _star(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of two tiles, each group of linked values as links to its smallest one."""
    rows = max(1, (1 << 21) // max(1, len(b)))
    i, j = [], []
    for at in range(0, len(a), rows):
        far = np.bitwise_count(a[at : at + rows, None] ^ b[None, :])
        x, y = np.nonzero(far <= radius)
        i.append(a[at + x])
        j.append(b[y])
    i, j = np.concatenate(i), np.concatenate(j)
    if not len(i):
        return i, j
    nodes, both = np.unique(np.concatenate([i, j]), return_inverse=True)
    x, y = both[: len(i)], both[len(i) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def links(distinct: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """``(a, b)``: links that join the same fingerprints as all pairs of ``distinct``
    (column ``fp``, no value twice) within ``radius`` bits do, directly or in steps."""
    quarters = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF) for q in range(QUARTERS)]
    counted = distinct.select("fp", *[F.bit_count(q).alias(f"q{k}") for k, q in enumerate(quarters)])
    names = [f"q{k}" for k in range(QUARTERS)]
    parts = counted.groupBy(*names).agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    tiles = (
        counted.join(parts, names)
        .withColumn("part", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
        .groupBy(*names, "part")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = stored(tiles.withColumn("cell", _cell([F.col(n) for n in names])), "tiles")
    offsets = _near(radius)
    steps = F.array(*[F.lit(sum(d * _STEP ** (QUARTERS - 1 - k) for k, d in enumerate(o))) for o in offsets])
    left = tiles.select("part", F.col("fps").alias("x"), F.explode(steps).alias("step"), "cell").select(
        "x", "part", (F.col("cell") + F.col("step")).alias("cell"), "step"
    )
    right = tiles.select("cell", F.col("part").alias("part_y"), F.col("fps").alias("y"))
    pairs = left.join(right, "cell").where((F.col("step") != 0) | (F.col("part") <= F.col("part_y")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            (xa, xs), (ya, ys) = (_lists(batch.column(k)) for k in (0, 1))
            for r in range(batch.num_rows):
                found.append(_star(xs[xa[r] : xa[r + 1]], ys[ya[r] : ya[r + 1]], radius))
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return pairs.select("x", "y").mapInArrow(run, "a long, b long")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).view(np.uint64)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(id, _row_id, _row_text, fp, root)``: the rows of ``fingerprints`` and a
    fingerprint that names the group of all that links can reach."""
    marks = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(marks.select("fp").distinct(), "distinct")
    roots = components(links(distinct, radius))
    known = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return marks.join(known, "fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per row of ``docs``.

    Texts whose fingerprints differ in ``radius`` bits or fewer are linked, and
    ``component_id`` is the smallest id that can be reached, the own one included.
    Texts without words (missing ones too) share fingerprint 0, which is linked like
    any other. Rows without an id get a component like all others; it is NULL only if
    no member has an id. Empty input gives no rows.
    """
    rows = stored(groups(docs, id_col, text_col, shingle, radius), "groups")
    # Stored, so Spark can split the rows of a large group in the join.
    smallest = stored(rows.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    return rows.join(smallest, "root").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the one with the
    smallest id (a missing id is smaller than all), of rows with that id the one with the
    smallest hash of its text, of equal rows any one."""
    first = groups(docs, id_col, text_col, shingle, radius).groupBy("root").agg(F.min(F.struct(ID_KEY, TEXT_KEY)).alias("k"))
    stay = packed(docs, id_col, text_col).join(first.select("k.*"), [ID_KEY, TEXT_KEY], "left_semi")
    return unpacked(stay.dropDuplicates([ID_KEY, TEXT_KEY]), docs.columns)
