"""Byte-level BPE encoding and decoding, each distinct word of a batch once.

Texts are parted into words for a whole batch at a time, by the kinds of their code
points (letter, digit, white space, other), and the distinct words are merged side by
side: each round joins the first pair of lowest rank of every word that has one, as the
encoding is defined. Rounds are no more than the bytes of the longest word.

Longer words go by a walk in linear time. In an encoding, each prefix of a word ends in
exactly one token, whatever follows later: the state of the prefix. A token may follow
a state if merging the bytes of both on their own gives back just these two. So a
word's state follows from states of its shorter prefixes, and words with a common
prefix share them. These words are visited in sorted order, which is the depth-first
order of their trie: going from one word to the next keeps the states of the common
prefix and computes the others, so each node of the trie is computed once.
"""

from __future__ import annotations

import functools
import itertools
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from culvert.llm.frames import slices, texts

# The pattern that parts texts into words, as published with the vocabulary, is
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

# Code points that newer Unicode tables than those of the tokenizers library
# hold as letters or digits, first and last of each range. To the library they are neither.
NEWER = """
0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF
A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 1246F-1246F
12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5
1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F
"""

#: Bytes of texts that are encoded together.
SLICE = 1 << 19
#: Bytes of the longest words that are merged side by side.
SHORT = 128
#: Bytes of encodings of longer words that a worker keeps from one batch to the next, in
#: each of two generations.
KEEP = 8 << 20
#: Bytes that an entry costs beside its key and its value.
_ENTRY = 96
#: Pairs of tokens of which a worker remembers whether one may follow the other, and
#: steps from a beginning of tokens by a byte.
PAIRS, STEPS = 500_000, 500_000

#: Rank of a pair that is never merged.
_NEVER = 1 << 60


def _byte_marks() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


#: Kinds of code points; those of white space come last.
_OTHER, _LETTER, _DIGIT, _SPACE, _BLANK = range(5)
#: Stands for the rank of a pair that is never merged, beside the places of ``SHORT`` bytes.
_NONE, _PLACE = (1 << 24) - 1, 7
_EMPTY = np.uint64(2**64 - 1)


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point in the library's Unicode tables."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):
        points = "".join(map(chr, range(lo, hi)))
        for kind, name in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(name, points):
                kinds[lo + m.start() : lo + m.end()] = kind
    for r in NEWER.split():
        lo, hi = (int(c, 16) for c in r.split("-"))
        kinds[lo : hi + 1] = _OTHER
    kinds[0x20] = _BLANK
    return kinds


def _starts(points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Does the pattern begin a word at each code point? ``fresh`` is true where a text
    begins, and behind the last."""
    n, kind = len(points), _kinds()[points]
    space = kind >= _SPACE
    start = fresh[:n].copy()
    # A blank belongs to the word behind it.
    start[1:] |= (np.minimum(kind[1:], _SPACE) != np.minimum(kind[:-1], _SPACE)) & (kind[:-1] != _BLANK)
    # Of white space before a word of the same text, the last stands alone or leads the word.
    start[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~fresh[2:n]
    # A short form after an apostrophe that stands alone.
    i = np.flatnonzero(start & (points == 0x27))
    i = i[i + 1 < n]
    i = i[(kind[i + 1] == _LETTER) & ~fresh[i + 1]]
    x, y = points[i + 1], points[np.minimum(i + 2, n - 1)]
    one = np.isin(x, [ord(c) for c in "stmd"])
    two = np.zeros(len(i), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (x == ord(a)) & (y == ord(b))
    two &= ~fresh[np.minimum(i + 2, n)]
    start[i[one | two] + 1] = False
    ends = np.concatenate([i[one] + 2, i[two] + 3])
    start[ends[ends < n]] = True
    return start


def _mixed(keys: np.ndarray) -> np.ndarray:
    x = keys * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


class Codec:
    """A vocabulary file of the tokenizers library with byte-level BPE."""

    def __init__(self, file: str):
        marks = _byte_marks()
        data = json.loads(file)
        raw = {t: bytes(marks[c] for c in t) for t in data["model"]["vocab"]}
        self.ids = {raw[t]: i for t, i in data["model"]["vocab"].items()}
        self.token = {i: t for t, i in self.ids.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.rank = {(raw[a], raw[b]): k for k, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.token |= {i: t.encode() for t, i in self.special.items()}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        #: Encodings, as 32-bit numbers, of words too long to be merged side by side, the
        #: latest ones and those before them.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the former
        self.size = {i: len(t) for i, t in self.token.items()}
        spelled = [self.token.get(i, b"") for i in range(1 + max(self.token))]
        self.lengths = np.array([len(t) for t in spelled])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.single = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int32)
        self._fill()
        self.goto: dict[int, int] = {}
        self.endings: dict[int, tuple[tuple[int, int], ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.halves = functools.cache(self._halves)
        self.edge = functools.cache(self._edge)

    def _fill(self) -> None:
        """The ranks of pairs of tokens as a table: a pair stands at its hash or, where
        that is taken, at the next free place."""
        pairs = [(self.ids[a] << 32 | self.ids[b], rank, self.ids[a + b]) for (a, b), rank in self.rank.items()]
        if any(rank >= _NONE for _, rank, _ in pairs):
            raise ValueError("too many merges")
        keys, ranks, joined = (np.array(c, t) for c, t in zip(zip(*pairs), (np.uint64, np.int32, np.int32))) if pairs else [np.zeros(0, np.int64)] * 3
        self.joined = np.zeros(1 + max(ranks, default=0), np.int32)
        self.joined[ranks] = joined
        size = 1 << (4 * len(keys)).bit_length()
        self.keys, self.ranks = np.full(size, _EMPTY), np.full(size, _NONE, np.int32)
        place, left = (_mixed(keys.astype(np.uint64)) & np.uint64(size - 1)).astype(np.int64), np.arange(len(keys))
        while len(left):
            _, first = np.unique(place[left], return_index=True)
            took = left[first]
            took = took[self.keys[place[took]] == _EMPTY]
            self.keys[place[took]], self.ranks[place[took]] = keys[took], ranks[took]
            left = left[self.keys[place[left]] != keys[left]]
            place[left] = (place[left] + 1) & (size - 1)

    def ranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        last = len(self.keys) - 1
        place = (_mixed(keys) & np.uint64(last)).astype(np.int64)
        there, found = self.keys[place], self.ranks[place]
        left = np.flatnonzero(there != keys)
        found[left] = _NONE
        left = left[there[left] != _EMPTY]
        while len(left):
            place[left] = (place[left] + 1) & last
            there = self.keys[place[left]]
            same = there == keys[left]
            found[left[same]] = self.ranks[place[left[same]]]
            left = left[~same & (there != _EMPTY)]
        return found

    def merge_words(self, body: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words of 1 to ``SHORT`` bytes that lie one behind the other, and
        the number of each word's. Every round merges, in each word, the first of its
        pairs of lowest rank."""
        token, left = self.single[body], np.arange(len(size))
        if len(token) and token.min() < 0:
            raise ValueError("the vocabulary can't encode every byte")
        n, start = size.copy(), np.cumsum(size) - size
        place = (np.arange(len(token)) - np.repeat(start, n)).astype(np.int32)
        rank = np.full(len(token), _NONE, np.int32)
        rank[:-1] = self.ranked(token[:-1], token[1:])
        rank[start + n - 1] = _NONE
        order = rank << _PLACE | place
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(left):
            low = np.minimum.reduceat(order, start)
            ready = low >= _NONE << _PLACE
            if ready.any():
                out = np.repeat(ready, n)
                done.append((left[ready], n[ready], token[out]))
                token, order, left, n, low = token[~out], order[~out], left[~ready], n[~ready], low[~ready]
                start = np.cumsum(n) - n
                if not len(left):
                    break
            i = np.flatnonzero(order == np.repeat(low, n))  # one in each word
            token[i] = self.joined[low >> _PLACE]
            stay = np.ones(len(token), bool)
            stay[i + 1] = False
            token, order = token[stay], order[stay]
            i -= np.arange(len(i))
            n = n - 1
            start = np.cumsum(n) - n
            order[i] |= _NONE << _PLACE
            after, before = i[i < start + n - 1], i[i > start] - 1
            both = np.concatenate([after, before])
            order[both] = self.ranked(token[both], token[both + 1]) << _PLACE | order[both] & SHORT - 1
        count = np.zeros(len(size), np.int64)
        for words, n, _ in done:
            count[words] = n
        first = np.cumsum(count) - count
        ids = np.empty(int(count.sum()), np.int32)
        for words, n, tokens in done:
            ids[np.arange(len(tokens)) + np.repeat(first[words] - (np.cumsum(n) - n), n)] = tokens
        return ids, count

    @functools.cached_property
    def names(self) -> list[bytes]:
        """Beginnings of tokens, the empty one first; the longest of them that ends a
        prefix is followed from byte to byte, and lists the tokens that end there."""
        return [b"", *sorted({t[:k] for t in self.ids for k in range(1, len(t) + 1)})]

    @functools.cached_property
    def number(self) -> dict[bytes, int]:
        return {t: k for k, t in enumerate(self.names)}

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge of a token's bytes joins; None if the
        merges don't lead to the token, which then never occurs in an encoding."""
        parts = [token[k : k + 1] for k in range(len(token))]
        last = None
        while len(parts) > 1:
            rank, k = min((self.rank.get(p, _NEVER), k) for k, p in enumerate(itertools.pairwise(parts)))
            if rank == _NEVER:
                return None
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return last

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts at a token's left (0) or right (1) end from its byte up to itself,
        each with the rank of the merge that takes it in."""
        if len(token) == 1:
            return [(token, _NEVER)]
        halves = self.halves(token)
        inner = self.edge(halves[side], side)
        return [*inner[:-1], (halves[side], self.rank[halves]), (token, _NEVER)]

    def follows(self, a: bytes, b: bytes) -> bool:
        """Whether merging the bytes of ``a + b`` leaves ``a`` and ``b``: going up both
        sides of the border in the order of merges, no pair across it comes first. Of
        equal pairs the one further left is merged first."""
        left, right = iter(self.edge(a, 1)), iter(self.edge(b, 0))
        (x, x_next), (y, y_next) = next(left), next(right)
        while True:
            across = self.rank.get((x, y), _NEVER)
            if across < x_next and across <= y_next and across != _NEVER:
                return False
            if x_next == y_next == _NEVER:
                return True
            if x_next <= y_next:
                x, x_next = next(left)
            else:
                y, y_next = next(right)

    def _step(self, key: int) -> int:
        """Where a byte leads from a beginning of tokens."""
        name = self.names[key >> 8] + bytes([key & 255])
        while name not in self.number:
            name = name[1:]
        node = self.goto[key] = self.number[name]
        if node not in self.endings:
            tails = (name[k:] for k in range(len(name)))
            self.endings[node] = tuple((self.ids[t], len(t)) for t in tails if t in self.ids and self._whole(t))
        return node

    def _whole(self, token: bytes) -> bool:
        """Whether a token's own bytes are encoded as the token."""
        return len(token) == 1 or self.halves(token) is not None

    def encode_words(self, words: set[bytes]) -> dict[bytes, list[int]]:
        """Token ids of distinct words."""
        goto, endings, size, pairs = self.goto, self.endings, self.size, self.pairs
        out, before = {}, b""
        states, nodes = [-1], [0]  # per prefix: its last token, and its longest end that begins one
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :], nodes[shared + 1 :]
            node, end = nodes[-1], shared
            for byte in word[shared:]:
                end += 1
                key = node << 8 | byte
                node = goto.get(key, -1)
                if node < 0:
                    node = self._step(key)
                for i, length in endings[node]:
                    last = states[end - length]
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | i)
                    if fits is None:
                        fits = pairs[last << 32 | i] = self.follows(self.token[last], self.token[i])
                    if fits:
                        break
                else:
                    raise ValueError(f"the vocabulary can't encode {word[:end]!r}")
                states.append(i)
                nodes.append(node)
            found = []
            while end:
                found.append(i := states[end])
                end -= size[i]
            found.reverse()
            out[word], before = found, word
        if len(pairs) > PAIRS:
            pairs.clear()
        if len(goto) > STEPS:
            goto.clear()
        return out

    def parted(self, body: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The first byte of each word, and of each special token spelled out, of texts
        that lie one behind the other (offsets ``at``)."""
        data = body.tobytes()
        if data.isascii():
            points, lead = body, np.arange(len(body))
        else:
            points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
            lead = np.flatnonzero((body & 0xC0) != 0x80)
        fresh = np.zeros(len(points) + 1, bool)
        fresh[np.searchsorted(lead, at)] = True
        spans = []
        if self.split and any(s.encode() in data for s in self.special):
            for lo, hi in itertools.pairwise(at.tolist()):
                text, first = data[lo:hi].decode(), np.searchsorted(lead, lo)
                spans += [(first + m.start(), first + m.end()) for m in self.split.finditer(text)]
        for a, b in spans:
            fresh[[a, b]] = True
        start = _starts(points, fresh)
        for a, b in spans:
            start[a + 1 : b] = False
        return lead[start]

    def encode_distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct words, one behind the other, and the number of each word's."""
        at, body = texts(words)
        size = np.diff(at)
        brief = size <= SHORT
        special = {t.encode(): i for t, i in self.special.items()}
        long = {k: words[k].as_py() for k in np.flatnonzero(~brief).tolist()}
        named = {}
        if special:
            found = pa.compute.index_in(pa.array(list(special), words.type), words).to_pylist()
            named = {k: np.int32(i).tobytes() for k, i in zip(found, special.values()) if k is not None}
        brief[list(named)] = False
        ids, count = self.merge_words(body[np.repeat(brief, size)], size[brief])
        if len(ids) and brief.all():
            return ids, count
        other = named | {k: code for k, code in self.encode_long(long).items() if k not in named}
        places = sorted(other)
        counts = np.zeros(len(words), np.int64)
        counts[brief] = count
        counts[places] = [len(other[k]) // 4 for k in places]
        whole = np.empty(int(counts.sum()), np.int32)
        mine = np.repeat(brief, counts)
        whole[mine] = ids
        whole[~mine] = np.frombuffer(b"".join(other[k] for k in places), np.int32)
        return whole, counts

    def encode_long(self, words: dict[int, bytes]) -> dict[int, bytes]:
        """Token ids of longer words as 32-bit numbers, remembered from batch to batch."""
        if self.held > KEEP:
            self.known, self.before, self.held = {}, self.known, 0
        new = {w for w in words.values() if w not in self.known}
        codes = {w: self.before[w] for w in new if w in self.before}
        codes |= {w: np.array(i, np.int32).tobytes() for w, i in self.encode_words(new - codes.keys()).items()}
        self.held += sum(_cost(w, code) for w, code in codes.items())
        self.known |= codes
        return {k: self.known[w] for k, w in words.items()}

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a column of texts, and the offsets of each text's."""
        at, body = texts(column)
        if not len(body):
            return np.zeros(0, np.int32), np.zeros(len(at), np.int64)
        first = self.parted(body, at)
        offsets = np.append(first, len(body)).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        ids, count = self.encode_distinct(coded.dictionary)
        word = coded.indices.to_numpy()
        size = count[word]
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) + np.repeat((np.cumsum(count) - count)[word] - (ends - size), size)
        return ids[index], np.concatenate([[0], ends])[np.searchsorted(first, at)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Token ids of each text as 32-bit numbers."""
        ids, offsets = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(offsets.tolist())]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of lists of ids that lie one behind the other."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        index = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        spelled = self.bytes[index].tobytes()
        borders = np.concatenate([[0], ends])[offsets].tolist()
        return [spelled[a:b].decode("utf-8", "replace") for a, b in itertools.pairwise(borders)]


def _cost(part: bytes, code: bytes) -> int:
    return sys.getsizeof(part) + sys.getsizeof(code) + _ENTRY


@functools.lru_cache(maxsize=2)
def _codec(file: str) -> Codec:
    return Codec(file)


def encode(docs: DataFrame, path: str, text_col: str = "text", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with a column ``tokens`` (array of int) more, equal to what the tokenizers
    library gives for the vocabulary at ``path`` without special tokens added; a special
    token that a text spells out is encoded as one. With ``decoded_col``, a column of that
    name more: what ``decode`` gives for the ids, in the same pass, so that a task needs one
    Python worker with one vocabulary rather than two.

    Missing and empty texts have no tokens. Rows are independent of each other: repeated
    rows, missing ids and other columns pass unchanged (columns of the new names are
    replaced). The vocabulary, a file of fixed size, is read by the driver and sent to the tasks.
    """
    with open(path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    inputs, at = docs.columns, docs.columns.index(text_col)
    names = [c for c in inputs if c not in ("tokens", decoded_col)]
    new = ["tokens", decoded_col] if decoded_col else ["tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file.value)
        for whole in batches:
            for lo, hi in slices(texts(whole.column(at))[0], SLICE):
                batch = whole.slice(lo, hi - lo)
                ids, offsets = codec.encode_column(batch.column(at))
                found = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
                if decoded_col:
                    found.append(pa.array(codec.decode(ids, offsets), pa.string()))
                columns = {c: batch.column(k) for k, c in enumerate(inputs)}
                yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), *found], names=[*names, *new])

    types = [T.ArrayType(T.IntegerType()), T.StringType()]
    schema = T.StructType([docs.schema[n] for n in names] + [T.StructField(n, t) for n, t in zip(new, types, strict=False)])
    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, tokens_col: str = "tokens", text_col: str = "decoded") -> DataFrame:
    """``tokens`` with a column ``text_col`` more: the text that the ids spell, special
    tokens included. Bytes that are no UTF-8 become U+FFFD; missing and empty lists
    become the empty text; an id outside the vocabulary is an error."""
    with open(path, encoding="utf-8") as f:
        file = tokens.sparkSession.sparkContext.broadcast(f.read())
    inputs, at = tokens.columns, tokens.columns.index(tokens_col)
    names = [c for c in inputs if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                lists = batch.column(at)
                lists = lists.fill_null([]) if lists.null_count else lists
                offsets = lists.offsets.to_numpy()
                ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
                found = codec.decode(ids, offsets - offsets[0])
                columns = {c: batch.column(k) for k, c in enumerate(inputs)}
                yield pa.RecordBatch.from_arrays(
                    [*(columns[n] for n in names), pa.array(found, pa.string())], names=[*names, text_col]
                )

    schema = T.StructType([tokens.schema[n] for n in names] + [T.StructField(text_col, T.StringType())])
    return tokens.mapInArrow(run, schema)
