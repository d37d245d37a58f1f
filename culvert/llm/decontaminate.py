"""Benchmark decontamination by spaced seeds.

A seed is a hash of the words that a fixed mask selects from a stretch; the places
that it leaves out may hold any word. Two masks are chosen such that a stretch of
``STRETCH`` words with up to two substitutions shares at least one seed with its
original, wherever the substitutions lie. Texts and items are joined by seed, and each
hit is verified: along the alignment that it implies, a window of ``STRETCH`` words
around it must agree in all but the tolerated words.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culvert.llm.frames import ID_KEY, NO_ID, TEXT_KEY, keyed, packed, slices, stored, texts, unpacked
from culvert.llm.wordhash import MARKS, Words, grams

STRETCH = 13
#: Places of the words that each mask selects.
MASKS = ((0, 1, 2, 5, 6, 7), (0, 2, 3, 5, 7, 8))
SPAN = 1 + max(map(max, MASKS))
#: Part of a stretch that substitutions may make up at most.
SUBSTITUTED = 0.2
#: Seeds that one pass over the texts looks for; more are looked for in more passes.
SEEDS = 1_000_000


def tolerated(length: int) -> int:
    """Substitutions in a stretch that never hide it from all masks."""
    for k in range(math.floor(SUBSTITUTED * length), 0, -1):
        places = [{o + p for p in m} for m in MASKS for o in range(length - max(m))]
        if all(any(not p & set(c) for p in places) for c in itertools.combinations(range(length), k)):
            return k
    return 0


_TOLERATED = {n: tolerated(n) for n in range(1, STRETCH + 1)}


def _seeds(words: Words, short: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and seeds by mask, and by the lengths of items too short for masks."""
    room = words.room()
    for k, mask in enumerate(MASKS):
        at = np.flatnonzero(room > max(mask))
        yield at, grams(words.hashes, len(mask), 10 + k, mask)[at]
    for n in short:
        at = np.flatnonzero(room >= n)
        yield at, grams(words.hashes, n, 100 + n)[at]


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return texts(pc.utf8_lower(column))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item_id, _row_id, _row_text, words, seeds)``: each item's word hashes, and its seeds with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, body = _lowered(batch.column(3))
            for lo, hi in slices(offsets):
                words = Words(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], MARKS)
                hashes, seeds = [], []
                for r in range(hi - lo):
                    one = words.hashes[words.first[r] : words.first[r + 1]]
                    hashes.append(one.view(np.int64).tolist())
                    alone = _Alone(one)
                    found = _seeds(alone, [len(one)] if 0 < len(one) < SPAN else [])
                    seeds.append([{"seed": int(s), "at": int(a)} for at, part in found for a, s in zip(at, part.view(np.int64), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in range(3)), pa.array(hashes, pa.list_(pa.int64())),
                     pa.array(seeds, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
                    names=["item_id", ID_KEY, TEXT_KEY, "words", "seeds"],
                )

    rows = keyed(benchmark, item_col, text_col)
    named = rows.select(F.when(F.col(ID_KEY) != NO_ID, F.col(ID_KEY)).alias("item_id"), ID_KEY, TEXT_KEY, F.col("text").cast("string"))
    return named.distinct().mapInArrow(
        run, f"item_id long, {ID_KEY} long, {TEXT_KEY} long, words array<long>, seeds array<struct<seed:long,at:int>>"
    )


class _Alone:
    """The words of one text, as ``Words`` has them."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def room(self) -> np.ndarray:
        return np.arange(len(self.hashes), 0, -1)


def _hits(docs: DataFrame, wanted: np.ndarray, short: list[int]) -> DataFrame:
    """``(_row_id, _row_text, seed, at, begin, near)``: places in texts with a wanted
    seed, and the word hashes around them."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    reach = STRETCH - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        bits = np.zeros(1 << 22, bool)
        bits[wanted >> np.uint64(42)] = True
        for batch in batches:
            offsets, body = _lowered(batch.column(2))
            for lo, hi in slices(offsets):
                words = Words(body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], MARKS)
                where, seeds = [], []
                for at, seed in _seeds(words, short):
                    maybe = np.flatnonzero(bits[seed >> np.uint64(42)])
                    maybe = maybe[np.isin(seed[maybe], wanted)]
                    where.append(at[maybe])
                    seeds.append(seed[maybe])
                at, seed = np.concatenate(where), np.concatenate(seeds)
                if not len(at):
                    continue
                row = np.searchsorted(words.first, at, "right") - 1
                begin = np.maximum(at - reach, words.first[row])
                sizes = np.minimum(at + SPAN + reach, words.first[row + 1]) - begin
                ends = np.cumsum(sizes)
                index = np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1])
                near = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(words.hashes[index].view(np.int64))
                )
                rows = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(seed.view(np.int64)),
                     pa.array(at - words.first[row]), pa.array(begin - words.first[row]), near],
                    names=[ID_KEY, TEXT_KEY, "seed", "at", "begin", "near"],
                )

    return docs.mapInArrow(run, f"{ID_KEY} long, {TEXT_KEY} long, seed long, at long, begin long, near array<long>")


def _verified(rows: DataFrame) -> DataFrame:
    """``(_row_id, _row_text, item_id, n_agree, n_window, word_at)``: the best window of each
    hit, the first of equal ones, if it agrees in all but the tolerated words. Expressions:
    a second Python step would double the Python workers of the tasks that find the hits."""
    item, text = F.size("words"), F.size("near")
    shift = (F.col("at") - F.col("begin") - F.col("item_at")).cast("int").alias("shift")  # the item's first word in ``near``
    rows = rows.select("*", shift, F.least(F.lit(STRETCH), item).alias("length"))
    first = F.greatest(F.lit(0), F.col("shift")).alias("first")
    rows = rows.select("*", first, (F.least(text, item + F.col("shift")) - first).alias("n")).where("n >= length")
    n, length = F.greatest("n", "length"), F.col("length")
    pairs = (F.slice("near", F.col("first") + 1, n), F.slice("words", F.col("first") - F.col("shift") + 1, n))
    same = F.zip_with(*pairs, lambda a, b: (a == b).cast("long"))
    # A bit per word, the first one highest; ``near`` has 2 * STRETCH - 2 + SPAN words at most.
    bits = F.aggregate(same, F.lit(0).cast("long"), lambda bits, one: bits * 2 + one)
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), length) - 1
    starts = F.sequence(F.lit(0), n - length)

    def agreeing(bits: Column) -> Column:
        return F.transform(starts, lambda k: F.bit_count(F.call_function("shiftright", bits, n - length - k).bitwiseAND(whole)))

    def best(counts: Column) -> Column:
        most = F.array_max(counts)
        return F.struct(most.alias("agree"), F.array_position(counts, most).alias("place"))

    # In arrays of one and exploded: a filter on it would be moved down and compute it anew.
    found = F.transform(F.transform(F.array(bits), agreeing), best)
    allowed = F.element_at(F.array(*[F.lit(k) for _, k in sorted(_TOLERATED.items())]), length)
    kept = F.explode(F.filter(found, lambda b: b["agree"] >= length - allowed)).alias("best")
    return rows.select(ID_KEY, TEXT_KEY, "item_id", "begin", "first", "length", kept).select(
        ID_KEY, TEXT_KEY, "item_id", F.col("best.agree").cast("long").alias("n_agree"), length.cast("long").alias("n_window"),
        (F.col("begin") + F.col("first") + F.col("best.place") - 1).alias("word_at"),
    )


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(_row_id, _row_text, doc_id, item_id, n_agree, n_window, word_at)``: texts that
    hold a stretch of a benchmark item, one row per text and item, with the best window.

    Words are lower-cased and parted by white space and ASCII punctuation. A stretch
    has ``STRETCH`` words, or as many as a shorter item has, and agrees in all but
    ``tolerated`` words; items of fewer words than a mask spans must occur as they are.
    Missing, empty and blank texts and items leak nothing. Repeated rows and items are
    reported once; rows with the same id and other texts are apart by ``_row_text``.
    The driver gets the seeds of the benchmark, at most ``SEEDS`` for each pass.
    """
    items = stored(_items(benchmark, item_col, item_text_col), "benchmark-items")
    seeds = items.select("item_id", ID_KEY, TEXT_KEY, F.explode("seeds").alias("s")).select("*", "s.seed", F.col("s.at").alias("item_at"))
    passes = max(1, math.ceil(seeds.count() / SEEDS))
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).where((F.col("n") > 0) & (F.col("n") < SPAN)).distinct().collect())
    texts_ = keyed(docs, id_col, text_col).select(ID_KEY, TEXT_KEY, F.col("text").cast("string"))
    found = None
    for k in range(passes):
        part = seeds.where(F.pmod("seed", F.lit(passes)) == k)
        wanted = np.array([r[0] for r in part.select("seed").distinct().collect()], np.int64).view(np.uint64)
        hits = _hits(texts_, np.sort(wanted), short)
        looked = part.select("seed", "item_at", F.col(ID_KEY).alias("item_key"), F.col(TEXT_KEY).alias("item_text"))
        known = items.select("item_id", F.col(ID_KEY).alias("item_key"), F.col(TEXT_KEY).alias("item_text"), "words")
        joined = hits.join(F.broadcast(looked), "seed").join(known, ["item_key", "item_text"])  # SEEDS rows at most
        one = _verified(joined.select(ID_KEY, TEXT_KEY, "item_id", "at", "begin", "near", "item_at", "words"))
        found = one if found is None else found.unionByName(one)
    best = F.max_by(F.struct("n_agree", "n_window", "word_at"), F.struct("n_agree", -F.col("word_at"))).alias("best")
    return found.groupBy(ID_KEY, TEXT_KEY, "item_id").agg(best).select(
        ID_KEY, TEXT_KEY, F.when(F.col(ID_KEY) != NO_ID, F.col(ID_KEY)).alias("doc_id"), "item_id", "best.*"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item of ``benchmark``, unchanged."""
    found = leaks(docs, benchmark, id_col, text_col).select(ID_KEY, TEXT_KEY).distinct()
    return unpacked(packed(docs, id_col, text_col).join(found, [ID_KEY, TEXT_KEY], "left_anti"), docs.columns)
