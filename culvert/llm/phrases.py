"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces at punctuation and pieces into words. Words whose hash hits
a trigger cut a piece into chunks, so equal passages are cut alike wherever they stand;
a chunk also holds the ``LONGEST - 1`` words after its own, so that every phrase that
begins in it lies whole inside it. Spark counts the distinct chunks: the dictionary and
its frequencies. Phrases are counted in the dictionary only, each with the frequency of
its chunk, and only where they begin in a chunk's own words, so what two chunks share
is counted once.

Passes over the dictionary narrow down what is counted by its text: hashes of words,
then hashes of pairs of words that are frequent themselves, then hashes of longer
phrases all of whose pairs are frequent, then the phrases left by their text, and at
last the words of these. What is frequent by hash is kept in
a bit map of fixed size; collisions let more through, never less, and the counts by text
decide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culvert.llm.frames import slices, stored, texts

#: Words of the longest phrase.
LONGEST = 5
#: One word in so many begins a chunk; a chunk has at most ``MOST`` words of its own.
TRIGGER, MOST = 16, 64
#: Bits of a map of frequent hashes (8 MB), whatever the corpus.
BITS = 1 << 26
#: Bytes of chunks that are counted together in a task.
READ = 8 << 20
#: Bytes of counts by text that a task adds up before it hands them on, and the tasks per
#: core that count so: each hands on a row for every phrase it has met.
HELD, TASKS = 32 << 20, 3

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A random number per byte; for triggers, none for bytes outside words.
_BYTES = np.random.default_rng(12).integers(1, 2**63, 256, np.uint64)
_MIXED = np.where(_KIND == _WORD, _BYTES, np.uint64(0))
_POWERS = np.cumprod(np.full(1024, _ODD))


def _spans(word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of each word; a word also ends with its text (offsets ``at``)."""
    edge = np.zeros(len(word) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    return np.flatnonzero(word & (~before | edge[:-1])), np.flatnonzero(word & (~after | edge[1:]))


def _gathered(body: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """Strings from byte ranges, which may overlap."""
    size = stop - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = body[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


def _chunked(body: np.ndarray, at: np.ndarray, trigger: int = TRIGGER, most: int = MOST) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, text and number of own words of every chunk of some texts."""
    kind = _KIND[body]
    start, last = _spans(kind == _WORD, at)
    if not len(start):
        return np.zeros(0, np.int64), pa.array([], pa.large_string()), np.zeros(0, np.int32)
    row = np.searchsorted(at, start, "right") - 1
    piece = np.cumsum(kind == _BREAK)[start] + row
    fresh = np.concatenate([[True], piece[1:] != piece[:-1]])
    hashed = np.add.reduceat(_MIXED[body], start) * _ODD
    cut = fresh | ((hashed >> np.uint64(40)) % np.uint64(trigger) == 0)
    places = np.arange(len(start))
    cut |= (places - places[cut][np.cumsum(cut) - 1]) % most == 0
    head = places[cut]
    until = np.concatenate([head[1:], [len(start)]])
    ends = np.concatenate([places[fresh][1:], [len(start)]])[np.cumsum(fresh) - 1]
    to = np.minimum(until + LONGEST - 1, ends[head]) - 1
    return row[head], _gathered(body, start[head], last[to] + 1), (until - head).astype(np.int32)


def chunks(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER, most: int = MOST
) -> DataFrame:
    """The dictionary ``(lang, chunk, own, freq)``: distinct chunks, the number of their
    own words, and how often each occurs. A missing language is ``und``; missing, empty
    and wordless texts have no chunks. Repeated rows count as often as they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, body = texts(batch.column(1))
            for a, b in slices(offsets):
                part = _LOWER[body[offsets[a] : offsets[b]]]
                row, chunk, own = _chunked(part, offsets[a : b + 1] - offsets[a], trigger, most)
                if len(row):
                    lang = batch.column(0).take(pa.array(row + a))
                    yield pa.RecordBatch.from_arrays([lang, chunk.cast(pa.string()), pa.array(own)], ["lang", "chunk", "own"])

    picked = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text"))
    return picked.mapInArrow(run, "lang string, chunk string, own int").groupBy("lang", "chunk", "own").agg(F.count("*").alias("freq"))


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash per text, from its bytes and their places. Equal hashes of different texts
    only let more through the maps."""
    at, body = texts(words)
    place = (np.arange(len(body)) - np.repeat(at[:-1], np.diff(at))) % len(_POWERS)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[body] * _POWERS[place])])
    x = (total[at[1:]] - total[at[:-1]]) * _ODD
    return (x ^ (x >> np.uint64(32))) * _ODD


@dataclass
class Parsed:
    """The words of some chunks, numbered by language and text."""

    text: pa.Array  # of the word with each number
    lang: pa.Array
    hashes: np.ndarray
    number: np.ndarray  # of each word of the chunks
    weight: np.ndarray  # frequency of its chunk; 0 outside the own words
    follows: np.ndarray  # does the next word stand in the same chunk?

    @classmethod
    def of(cls, some: pa.Table) -> Parsed:
        at, body = texts(some["chunk"])
        inside = _KIND[body] == _WORD
        start, last = _spans(inside, at)
        size = np.concatenate([[0], np.cumsum(last - start + 1)])
        coded = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(size.astype(np.int64)), pa.py_buffer(body[inside])
        ).dictionary_encode()
        lang = some["lang"].combine_chunks().dictionary_encode()
        each = np.bincount(np.searchsorted(at, start, "right") - 1, minlength=some.num_rows)
        row = np.repeat(np.arange(some.num_rows), each)
        place = np.arange(len(start)) - np.repeat(np.cumsum(each) - each, each)
        live = place < some["own"].to_numpy()[row]
        langs = max(1, len(lang.dictionary))
        both = coded.indices.to_numpy().astype(np.int64) * langs + lang.indices.to_numpy()[row]
        there = np.zeros(len(coded.dictionary) * langs, bool)
        there[both] = True
        distinct = np.flatnonzero(there)
        hashed, spoken = _hashes(coded.dictionary), _hashes(lang.dictionary)
        return cls(
            coded.dictionary.take(pa.array(distinct // langs)),
            lang.dictionary.take(pa.array(distinct % langs)),
            _pair_hash(spoken[distinct % langs], hashed[distinct // langs]),
            (np.cumsum(there) - 1)[both],
            np.where(live, some["freq"].to_numpy()[row], 0),
            np.concatenate([row[1:] == row[:-1], [False]]) if len(row) else np.zeros(0, bool),
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Parsed]:
    """Chunks some ``READ`` bytes at a time: the more, the fewer repeat each other's words."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= READ:
            yield Parsed.of(pa.Table.from_batches(held))
            held = []
    if held:
        yield Parsed.of(pa.Table.from_batches(held))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b << np.uint64(31) | b >> np.uint64(33))) * _ODD
    return x ^ (x >> np.uint64(29)) ^ (a + b * _ODD)


def _summed(codes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, a place and the total weight of each, and the number of each code."""
    distinct, place, number = np.unique(codes, return_index=True, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, number, weight)
    return distinct, place, total, number


def _hit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _word_hashes(p: Parsed) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(len(p.hashes), np.int64)
    np.add.at(total, p.number, p.weight)
    return p.hashes, total


def _pair_hashes(p: Parsed, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    often = _hit(frequent, p.hashes)[p.number]
    i = np.flatnonzero(often[:-1] & often[1:] & p.follows[:-1] & (p.weight[:-1] > 0))
    known = max(1, len(p.hashes))
    pairs, _, total, _ = _summed(p.number[i] * known + p.number[i + 1], p.weight[i])
    return _pair_hash(p.hashes[pairs // known], p.hashes[pairs % known]), total


def _linked(p: Parsed, frequent: np.ndarray, paired: np.ndarray) -> np.ndarray:
    """Is each word frequent, and the pair with the next one?"""
    often = _hit(frequent, p.hashes)[p.number]
    linked = np.zeros(len(often), bool)
    i = np.flatnonzero(often[:-1] & often[1:] & p.follows[:-1])
    linked[i] = _hit(paired, _pair_hash(p.hashes[p.number[i]], p.hashes[p.number[i + 1]]))
    return linked


def _long_hashes(p: Parsed, frequent: np.ndarray, paired: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of three words or more, all of whose pairs are frequent."""
    linked = _linked(p, frequent, paired)
    start = np.flatnonzero(linked & (p.weight > 0))
    hashes = _pair_hash(p.hashes[p.number[start]], p.hashes[p.number[start + 1]])
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for length in range(3, LONGEST + 1):
        on = linked[start + length - 2]
        start = start[on]
        hashes = _pair_hash(hashes[on], p.hashes[p.number[start + length - 1]])
        distinct, _, total, _ = _summed(hashes, p.weight[start])
        found.append((distinct, total))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _phrases(p: Parsed, frequent: np.ndarray, paired: np.ndarray, longer: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Language, text, words and weight of the phrases of two words or more that may be frequent."""
    known = max(1, len(p.hashes))
    linked = _linked(p, frequent, paired)
    start = np.flatnonzero(linked & (p.weight > 0))
    code, hashes = p.number[start], p.hashes[p.number[start]]
    for length in range(2, LONGEST + 1):
        on = linked[start + length - 2]
        start, code = start[on], code[on]
        hashes = _pair_hash(hashes[on], p.hashes[p.number[start + length - 1]])
        if length > 2:
            on = _hit(longer, hashes)
            start, code, hashes = start[on], code[on], hashes[on]
        _, place, total, code = _summed(code * known + p.number[start + length - 1], p.weight[start])
        words = [p.text.take(pa.array(p.number[start[place] + k])) for k in range(length)]
        yield _counted(p, start[place], pa.compute.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())), length, total)


def _words(p: Parsed, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The same for single words, those that ``wanted`` lets through."""
    some = np.flatnonzero(_hit(wanted, p.hashes)[p.number] & (p.weight > 0))
    number, place, total, _ = _summed(p.number[some], p.weight[some])
    yield _counted(p, some[place], p.text.take(pa.array(number)), 1, total)


def _counted(p: Parsed, place: np.ndarray, phrase: pa.Array, length: int, total: np.ndarray) -> pa.RecordBatch:
    lang = p.lang.take(pa.array(p.number[place]))
    size = pa.array(np.full(len(total), length, np.int32))
    return pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), size, pa.array(total)], ["lang", "phrase", "words", "n"])


def _added(parts: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """The counts of a task with those of equal phrases added up, ``most`` bytes at a time."""
    held, fresh, rows = [], [], 0

    def added() -> list[pa.RecordBatch]:
        whole = pa.Table.from_batches([*held, *fresh]).group_by(["lang", "phrase", "words"], use_threads=False).aggregate([("n", "sum")])
        return whole.select(["lang", "phrase", "words", "n_sum"]).rename_columns(["lang", "phrase", "words", "n"]).combine_chunks().to_batches()

    for part in parts:
        fresh.append(part)
        rows += part.num_rows
        if rows >= sum(b.num_rows for b in held) or sum(b.nbytes for b in fresh) >= most:
            held, fresh, rows = added(), [], 0
            if sum(b.nbytes for b in held) >= most:
                yield from held
                held = []
    if fresh:
        held = added()
    yield from held


def _partial(dictionary: DataFrame, pick: Callable[[Parsed], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``(lang, phrase, words, n)``: the counts by text that ``pick`` finds, to be summed.
    Their number is that of the phrases times that of the tasks. A task reads its part a
    few MB at a time and holds counts of a fixed size, so it may read any number of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _added(part for parsed in _read(batches) for part in pick(parsed))

    tasks = TASKS * dictionary.sparkSession.sparkContext.defaultParallelism
    return dictionary.coalesce(tasks).mapInArrow(run, "lang string, phrase string, words int, n long")


def _mapped(often: DataFrame, size: int) -> np.ndarray:
    """Bit map of the places (column ``h``)."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)))
    got = often.groupBy(F.shiftright("h", 6).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()  # a row per 64 bits at most
    bits = np.zeros(size // 64, np.uint64)
    bits[got["cell"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return bits


def _frequent(dictionary: DataFrame, found: Callable[[Parsed], tuple[np.ndarray, np.ndarray]], least: int, size: int) -> np.ndarray:
    """Bit map of the hashes that ``found`` counts to ``least`` or more in all. Counted by
    their place in the map, so what is shuffled has no more rows per task than the map
    has bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parsed in _read(batches):
            hashes, total = found(parsed)
            some = total > 0
            place = (hashes[some] & np.uint64(size - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[some])], ["h", "n"])

    return _mapped(dictionary.mapInArrow(run, "h int, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least), size)


def _spoken(phrases: DataFrame, size: int) -> np.ndarray:
    """Bit map of the words of some phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _pair_hash(_hashes(batch.column(0)), _hashes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array((hashes & np.uint64(size - 1)).astype(np.int32))], ["h"])

    words = phrases.select("lang", F.explode(F.split("phrase", " ")).alias("word")).distinct()
    return _mapped(words.mapInArrow(run, "h int"), size)


def phrase_counts(dictionary: DataFrame, least: int = 100, bits: int = BITS) -> DataFrame:
    """``(lang, phrase, words, f)``: all phrases of 2 to ``LONGEST`` words that occur
    ``least`` times or more in their language, and at least all single words in them."""
    share = dictionary.sparkSession.sparkContext.broadcast
    frequent = share(_frequent(dictionary, _word_hashes, least, bits))
    paired = share(_frequent(dictionary, lambda p: _pair_hashes(p, frequent.value), least, bits))

    def counted(pick: Callable[[Parsed], Iterator[pa.RecordBatch]]) -> DataFrame:
        return _partial(dictionary, pick).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)

    longer = share(_frequent(dictionary, lambda p: _long_hashes(p, frequent.value, paired.value), least, bits))
    found = stored(counted(lambda p: _phrases(p, frequent.value, paired.value, longer.value)), "phrases")
    wanted = share(_spoken(found, bits))
    return found.unionByName(counted(lambda p: _words(p, wanted.value)))


def _part(words: Column, start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words or more with their lowest-scoring cut."""
    split = F.split("phrase", " ")
    cuts = counts.where("words > 1").select(
        "lang", "phrase", F.col("f").alias("a"), split.alias("split"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        _part(F.col("split"), 1, F.col("k")).alias("first"),
        _part(F.col("split"), F.col("k") + 1, F.size("split")).alias("rest"),
    )
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("(1000 * cast(a AS decimal(18,0)) * cast(n AS decimal(16,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))")
    joined = parts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    worst = joined.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")


def _contained(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, most)``: for phrases inside longer ones, the count of the most frequent of those."""
    starts = F.sequence(F.lit(1), F.col("words"))
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    longer = counts.where("words > 2").select("lang", "f", "words", F.split("phrase", " ").alias("split"), F.explode(lengths).alias("length"), starts.alias("starts"))
    each = longer.select("lang", "f", "split", "length", F.explode(F.filter("starts", lambda s: s + F.col("length") - 1 <= F.col("words"))).alias("s"))
    return each.groupBy("lang", _part(F.col("split"), F.col("s"), F.col("length")).alias("phrase")).agg(F.max("f").alias("most"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    best: int = 2000,
    share: int = 100,
    trigger: int = TRIGGER,
    most: int = MOST,
    bits: int = BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: per language the ``best`` phrases of
    2 to ``LONGEST`` words.

    ``n`` is the number of words of the language and ``a`` the number of times the
    phrase occurs, ``least`` or more. Cut after its first words, a phrase scores
    ``floor(1000 * a * n / (l * r))`` with the counts of its two parts; its
    lowest-scoring cut counts, of equal ones the first. A phrase inside a longer one
    that occurs at least ``share`` percent as often is left out. Ranks go by score,
    count and text (in byte order), so ties have one order. A missing language is
    ``und``, a missing text empty; repeated rows count as often as they occur, ids and
    other columns are not read, and an empty table has no phrases.
    """
    dictionary = stored(chunks(docs, text_col, lang_col, trigger, most), "chunks")
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    counts = stored(phrase_counts(dictionary, least, bits), "phrases")
    scored = _scored(counts, totals).join(_contained(counts), ["lang", "phrase"], "left")
    left = scored.where(F.coalesce(100 * F.col("most") < share * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
