"""The operators' results the long way."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"


def fingerprint(text: str | None) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def components(prints: list[int], radius: int = 3) -> list[int]:
    """Index of the first member of each one's component."""
    values = np.array(prints, np.uint64)
    root = list(range(len(prints)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= radius):
            a, b = find(k), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(prints))]


def in_order(keyed: list[tuple]) -> list[tuple]:
    """Distinct (id key, text hash, text) in the order of the operators."""
    return sorted(set(keyed), key=lambda r: (r[0], r[1]))


def cut_words(texts: list[str], window: int = 20) -> list[tuple[str, int, int]]:
    seen, out = set(), []
    for text in texts:
        words = WORD.findall(text)
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out.append((" ".join(w for w, g in zip(words, gone) if not g), len(words), sum(gone)))
    return out


def cut_lines(texts: list[str], run: int = 2, long_line: int = 8) -> list[tuple[str, int, int]]:
    seen, out = set(), []
    for text in texts:
        lines = text.split("\n")
        places = [k for k, line in enumerate(lines) if line.strip(BLANK)]
        held = [lines[k].strip(BLANK) for k in places]
        drop = set()
        for s in range(len(held)):
            for size in (1, run):
                key = tuple(held[s : s + size])
                if len(key) < size or (size == 1 and len(WORD.findall(held[s])) < long_line):
                    continue
                if key in seen:
                    drop.update(places[s : s + size])
                seen.add(key)
        out.append(("\n".join(x for k, x in enumerate(lines) if k not in drop), len(places), len(drop)))
    return out


def quality(text: str | None) -> tuple:
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


PLAIN = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def secrets(text: str | None) -> str:
    found = [
        (m.start(), k, f"{name}:{m.start()}:{m.end()}")
        for k, (name, pattern, group, least) in enumerate(PLAIN)
        for m in pattern.finditer(text or "")
        if len(m[group]) >= least
    ]
    return ",".join(f[2] for f in sorted(found))


def plain_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def leaks(text: str | None, item: str | None, tolerated: dict[int, int], stretch: int = 13) -> bool:
    a, b = plain_words(text), plain_words(item)
    n = min(stretch, len(b))
    if not n:
        return False
    places: dict[str, list[int]] = {}
    for k, w in enumerate(a):
        places.setdefault(w, []).append(k)
    shifts = Counter(k - j for j, w in enumerate(b) for k in places.get(w, ()))
    for shift in (s for s, agree in shifts.items() if agree >= n - tolerated[n]):
        same = [a[shift + k] == b[k] if 0 <= shift + k < len(a) else None for k in range(len(b))]
        for s in range(len(b) - n + 1):
            part = same[s : s + n]
            if None not in part and sum(part) >= n - tolerated[n]:
                return True
    return False
