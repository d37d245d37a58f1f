"""Spelling variants: words one edit apart, grouped below their frequent form.

Two words that differ by one inserted, deleted or replaced code point share either the
first half of the shorter one or all that follows it. Words are keyed by both, per
length of the shorter word; Spark deals the keys to tiles of bounded size, and numpy
compares the words of a tile as padded matrices of code points, all at once: a pair is
one edit apart if its common prefix and common suffix together reach the longer
length minus one. A key with more words than a tile holds is cut into blocks, and each
pair of blocks is a tile of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culvert.llm.frames import stored

#: Words in a tile, about, and code points in one.
TILE, TILE_CHARS = 512, 1 << 20
#: Shortest word, fewest occurrences, and how much more often a form occurs than its variant.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One in so many runs of a document loses a code point.
NOISE = 31

_LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(doc_id: int | None, text: str, least: int = LEAST_LENGTH, noise: int = NOISE) -> Counter[str]:
    """Words of one text and how often they occur, after the noise."""
    out: Counter[str] = Counter()
    head = b"%d:" % doc_id if doc_id is not None else b":"
    start = zlib.crc32(head)
    for word, n in Counter(re.findall(rf"[{_LETTERS}]{{{least},}}", text)).items():
        word = word.translate(_LOWER)
        if noise and (h := zlib.crc32(word.encode(), start)) % noise == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least:
                continue
        out[word] += n
    return out


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, seen: int = LEAST_COUNT, noise: int = NOISE
) -> DataFrame:
    """``(word, n)``: words of ``least`` code points or more that occur ``seen`` times
    or more. Counted per batch before any row is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for word, n in words_of(doc_id, text.as_py() or "", least, noise).items():
                    found[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    picked = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def _keyed(words: DataFrame, least: int) -> DataFrame:
    """``(short, side, key, word, n)``: each word under its keys, ``short`` being the
    length of the shorter word of the pairs they are for, ``least`` or more."""

    def keys(short: Column) -> list[Column]:
        half = (short / 2).cast("int")
        ends = (("head", F.left("word", half)), ("tail", F.right("word", short - half)))
        return [F.struct(short.alias("short"), F.lit(side).alias("side"), key.alias("key")) for side, key in ends]

    size = F.length("word")
    each = F.array(*keys(size), *keys(size - 1))
    return words.select("word", "n", F.explode(each).alias("k")).select("k.*", "word", "n").where(F.col("short") >= least)


def _tiles(words: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """The keyed words with the tile that they go to: ``(short, side, slot, own, i, j,
    block, word, n)``. Small keys share tiles; a key with more words than a tile holds
    goes to one per pair of its blocks."""
    keyed = _keyed(words, least)
    room = F.greatest(F.least(F.lit(TILE), (F.lit(TILE_CHARS) / F.col("short")).cast("int")), F.lit(8))
    per_key = keyed.groupBy("short", "side", "key").agg(F.count("*").alias("c"))
    per_side = per_key.groupBy("short", "side").agg(F.ceil(F.sum("c") / F.max(room)).cast("int").alias("slots"))
    large = per_key.where(F.col("c") > 2 * room).select("short", "side", "key", F.ceil(F.col("c") / room).cast("int").alias("blocks"))
    placed = keyed.join(per_side, ["short", "side"]).join(large, ["short", "side", "key"], "left")
    hot = F.col("blocks").isNotNull()
    block = F.when(hot, F.pmod(F.xxhash64("word"), "blocks").cast("int")).otherwise(0)
    others = F.explode(F.when(hot, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0))))
    return (
        placed.withColumns({"block": block, "other": others})
        .select(
            "short", "side",
            F.when(hot, -1).otherwise(F.pmod(F.xxhash64("key"), "slots").cast("int")).alias("slot"),
            F.when(hot, F.col("key")).otherwise("").alias("own"),
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block", "word", "n",
        )
    )


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one row each, padded with 0; and their lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(size.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return (out.astype(np.uint8) if out.max(initial=0) < 256 else out), size


def _common(a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` with each row of ``b``."""
    same, run = wanted.copy(), np.zeros(wanted.shape, np.int32)
    for k in range(min(a.shape[1], b.shape[1])):
        same &= a[:, k, None] == b[None, :, k]
        if not same.any():
            break
        run += same
    return run


def _turned(chars: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rows read from their ends."""
    at = size[:, None] - 1 - np.arange(chars.shape[1])
    return np.where(at >= 0, np.take_along_axis(chars, np.maximum(at, 0), 1), 0)


def near(words: list[str], blocks: np.ndarray, short: int, side: str, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile that are one edit apart, are ``short`` code points long or one of
    them one more, and share the key of this side; those that share both keys are left
    to the heads. ``cross``: only pairs of words of different blocks."""
    chars, size = _padded(words)
    one = np.flatnonzero(size == short)
    two = np.arange(len(words))
    a, b = (chars[one], size[one]), (chars, size)
    wanted = (size[one][:, None] < size[None, :]) | (one[:, None] < two[None, :])
    if cross:
        wanted &= blocks[one][:, None] != blocks[None, :]
    half = short // 2
    head = _common(a[0], b[0], wanted)
    wanted &= (head >= half) if side == "head" else (head < half)
    tail = _common(_turned(*a), _turned(*b), wanted)
    # Padding may count as common beyond a word's end, never in the sum that decides.
    longer = np.maximum(a[1][:, None], b[1][None, :])
    reach = np.minimum(head, short) + np.minimum(tail, short)
    x, y = np.nonzero(wanted & (reach >= longer - 1) & ((head >= half) if side == "head" else (tail >= short - half)))
    return one[x], two[y]


def _near_words(tiles: DataFrame) -> DataFrame:
    """``(word, n_near, best)``: per tile and word the near words and the most frequent one."""

    def run(table: pa.Table) -> pa.Table:
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        short, side, i, j = (table[c][0].as_py() for c in ("short", "side", "i", "j"))
        x, y = near(words, table["block"].to_numpy(), short, side, i != j)
        here, there = np.concatenate([x, y]), np.concatenate([y, x])
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=lambda k: (-n[k], words[k]))] = np.arange(len(words))
        order = np.lexsort((rank[there], here))
        here, there = here[order], there[order]
        who, first, count = np.unique(here, return_index=True, return_counts=True)
        best = there[first]
        return pa.table(
            {
                "word": pa.array([words[k] for k in who], pa.string()),
                "n_near": pa.array(count.astype(np.int64)),
                "neg_n": pa.array(-n[best]),
                "form": pa.array([words[k] for k in best], pa.string()),
            }
        )

    found = tiles.groupBy("short", "side", "slot", "own", "i", "j").applyInArrow(run, "word string, n_near long, neg_n long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("neg_n", "form")).alias("best"))


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``(word, root)`` for the words with a form. Each step multiplies the count by
    ``ratio`` or more, so that ``most`` bounds the steps; each join doubles them."""
    steps, doublings = 1, 0
    while ratio**steps <= most:
        steps += 1
    while 2**doublings < steps:
        doublings += 1
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(doublings):
        roots = stored(roots, "roots")
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return roots


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, seen: int = LEAST_COUNT, ratio: int = RATIO, noise: int = NOISE
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of the vocabulary.

    ``n_near`` words differ from the word by one inserted, deleted or replaced code
    point. The most frequent of them, of equal ones the first in code-point order, is
    its form if it occurs ``ratio`` times (2 or more) as often; ``root`` follows the
    forms to the last, and is the word itself where it has none. Missing and empty
    texts have no words, a missing id counts as empty in the noise, repeated rows count
    as often as they occur; other columns are not read. No words give no rows.
    """
    words = stored(vocabulary(docs, id_col, text_col, least, seen, noise), "words")
    near_words = stored(_near_words(_tiles(words, least)), "near")
    enough = F.when(-F.col("best.neg_n") >= ratio * F.col("n"), F.col("best"))
    all_words = words.join(near_words, "word", "left").select("word", "n", "n_near", enough.alias("best"))
    out = stored(all_words.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.neg_n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(out.where("form IS NOT NULL"), most, ratio)
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )
