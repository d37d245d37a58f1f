"""Main text of HTML pages by a recurrent labeller of blocks.

A page is the sequence of its leaf blocks. Each block is a vector of its tag path
(tag names, classes and ids, hashed), all its words (hashed, normalised to length one),
its first and last word once more, and a few shares; a
bidirectional LSTM in numpy reads the sequence both ways, so a block is judged with
the whole page around it. It is trained on a bounded sample of the pages themselves:
as they are, where an article element says which blocks are main text, and rearranged
into other layouts, with other names, notices, forms and reader comments. Where no page
has such an element, only rearranged ones are used, with long texts without links as
main text.
"""

from __future__ import annotations

import html as entities
import bisect
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Places of a block's path, of its first and last word, of all its words, and shares.
PATH_PLACES, END_PLACES, WORD_PLACES, SHARES, HIDDEN = 96, 24, 256, 6, 16
PLACES = PATH_PLACES + END_PLACES + WORD_PLACES + SHARES
#: Pages used for training, and the longest of them in characters.
SAMPLE, SAMPLE_CHARS = 200, 100_000
EPOCHS, BATCH, RATE = 12, 16, 0.01
#: Blocks read together, unless one page has more.
BLOCKS = 1 << 15

# Elements that do not end a block, that hold no text, and that have no end.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("script style noscript template svg math iframe object canvas select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open element of the first kind.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

#: Elements of other languages, in which a slash ends any element.
_FOREIGN = frozenset(("svg", "math"))
#: What surrounds reader comments, adverts, menus and forms inside an article.
_NESTED = frozenset("aside nav form footer .comment .comments .advert .ad .ads .sidebar".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">]++)*+)>|<[!?][^>]*>", re.DOTALL)
_HEAD = re.compile(r"</?[a-zA-Z][^\s/><]*+")
_MARKED = re.compile("[\"'>]")
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PART = re.compile(r"[A-Za-z]+")
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


class _Tags:
    """Tags, comments and declarations of a page, found in time linear in it, whatever is
    left open. A tag ends with the first ``>`` outside quotes; what has no end is text."""

    def __init__(self, page: str):
        self.page, self.last, self.marks, self.shut = page, page.rfind(">"), [], []

    def next(self, at: int) -> re.Match | None:
        """The first one from a place on."""
        while (at := self.page.find("<", at)) >= 0:
            if (not self.shut or self._ends(at)) and (m := _TAG.match(self.page, at)):
                return m
            if not self.shut:
                self._look_ahead()
            at += 1
        return None

    def _look_ahead(self) -> None:
        """For each mark, read from the end of the page, whether a ``>`` outside quotes follows."""
        self.marks = [m.start() for m in _MARKED.finditer(self.page)]
        self.shut = [False] * (len(self.marks) + 1)
        behind: dict[str, int] = {}  # the mark behind the next quote of a kind
        for k in range(len(self.marks) - 1, -1, -1):
            mark = self.page[self.marks[k]]
            if mark == ">":
                self.shut[k] = True
            else:
                self.shut[k] = mark in behind and self.shut[behind[mark]]
                behind[mark] = k + 1

    def _ends(self, at: int) -> bool:
        if self.page.startswith("<!--", at):
            return True
        if self.page[at + 1 : at + 2] in ("!", "?"):
            return self.last > at
        head = _HEAD.match(self.page, at)
        return head is not None and self.shut[bisect.bisect_left(self.marks, head.end())]


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order, with references decoded and white space joined. The
    path of a block has the names around it, each once. A slash at the end of a tag closes
    inline and foreign elements only; a silent element with one and no end tag is empty."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    opened: Counter[str] = Counter()  # of the stack
    endless: set[str] = set()  # silent elements that don't end any more
    linked, path = 0, ()
    page = page or ""
    tags = _Tags(page)

    def leave(k: int) -> None:
        opened.subtract(tag for tag, _ in stack[k:])
        del stack[k:]

    def close() -> None:
        nonlocal linked, path
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(path, text, linked))
            parts.clear()
        linked, path = 0, ()

    def say(raw: str) -> None:
        nonlocal linked, path
        text = entities.unescape(raw) if "&" in raw else raw
        if not parts and not text.strip():
            return
        if not parts:
            path = stack[-1][1] if stack else ()
        parts.append(text)
        if opened["a"]:
            linked += len(text)

    at, size = 0, len(page)
    while at < size:
        m = tags.next(at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in INLINE:
                close()
            if opened[tag]:
                leave(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        slash = m[3].endswith("/")
        if tag in SILENT:
            if slash and (tag in _FOREIGN or tag in endless):
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
            elif slash:
                endless.add(tag)
            else:
                at = size
            continue
        if tag in INLINE:
            if tag == "br" and parts:
                parts.append(" ")
        else:
            close()
            ends = _ENDS.get(tag, set()) | {"p"}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    leave(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag not in VOID and not (slash and tag in INLINE):
            above = stack[-1][1] if stack else ()
            new = [n for n in dict.fromkeys((tag, *_names(m[3]))) if n not in above]
            stack.append((tag, (*above, *new) if new else above))
            opened[tag] += 1
    close()
    return out


def _names(attributes: str) -> list[str]:
    """Words of the classes, id and role."""
    if not attributes.strip():
        return []
    found = (a or b or c for _, a, b, c in _NAME.findall(attributes))
    return ["." + p.lower() for value in found for p in _PART.findall(value)]


def _place(word: str, places: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % places


@lru_cache(1 << 17)
def _word_place(word: str) -> int:
    return _place(word.lower(), WORD_PLACES)


def vectors(found: list[Block]) -> np.ndarray:
    """One row per block."""
    x = np.zeros((len(found), PLACES), np.float32)
    for k, b in enumerate(found):
        for name in b.path:
            x[k, _place(name, PATH_PLACES)] = 1.0
        words = _LETTERS.findall(b.text)
        for w in words[:1]:
            x[k, PATH_PLACES + _place(w.lower(), END_PLACES)] += 0.5
        for w in words[-1:]:
            x[k, PATH_PLACES + _place("$" + w.lower(), END_PLACES)] += 0.5
        if words:
            of_words = np.bincount([_word_place(w) for w in words], minlength=WORD_PLACES)
            x[k, PATH_PLACES + END_PLACES : -SHARES] = of_words / np.sqrt((of_words * of_words).sum())
        n = len(b.text)
        x[k, -SHARES:] = (
            np.log1p(n) / 8,
            b.linked / n,
            np.log1p(len(words)) / 6,
            sum(b.text.count(c) for c in ".,;:!?") / max(1, len(words)),
            k / max(1, len(found) - 1),
            1.0,
        )
    return x


# --- the network -------------------------------------------------------------


@dataclass
class Network:
    """Weights of both directions (input, recurrent, bias) and of the output."""

    w: list[np.ndarray]

    @staticmethod
    def new(rng: np.random.Generator) -> Network:
        w = []
        for _ in range(2):
            w.append(rng.normal(0, 0.15, (PLACES, 4 * HIDDEN)).astype(np.float32))
            w.append(rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32))
            b = np.zeros(4 * HIDDEN, np.float32)
            b[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
            w.append(b)
        return Network([*w, rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)])

    def run(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """Probabilities for pages (pages x blocks x places), and what training needs."""
        sides = [_forward(x, mask, *self.w[:3]), _forward(x[:, ::-1], mask[:, ::-1], *self.w[3:6])]
        h = np.concatenate([sides[0][0], sides[1][0][:, ::-1]], axis=2)
        return 1 / (1 + np.exp(-(h @ self.w[6] + self.w[7]))), [h, sides]

    def gradients(self, x: np.ndarray, mask: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
        p, (h, sides) = self.run(x, mask)
        d = ((p - goal) * mask / mask.sum()).astype(np.float32)
        dh = d[:, :, None] * self.w[6]
        first = _backward(x, mask, dh[:, :, :HIDDEN], sides[0], *self.w[:2])
        second = _backward(x[:, ::-1], mask[:, ::-1], dh[:, ::-1, HIDDEN:], sides[1], *self.w[3:5])
        return [*first, *second, np.einsum("ntd,nt->d", h, d), np.array([d.sum()], np.float32)]


def _forward(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple:
    n, steps, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    pre = x @ w + b
    hs, kept = np.zeros((n, steps, HIDDEN), np.float32), []
    for t in range(steps):
        z = pre[:, t] + h @ u
        gate = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t, None]
        before = (h, c)
        new = f * c + i * g
        c = m * new + (1 - m) * c
        q = np.tanh(c)
        h = m * (o * q) + (1 - m) * h
        kept.append((i, f, o, g, q, before))
        hs[:, t] = h
    return hs, kept


def _backward(x: np.ndarray, mask: np.ndarray, dh_out: np.ndarray, side: tuple, w: np.ndarray, u: np.ndarray) -> list[np.ndarray]:
    n, steps, _ = x.shape
    dz_all = np.zeros((n, steps, 4 * HIDDEN), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, q, (h0, c0) = side[1][t]
        m = mask[:, t, None]
        dh = dh + dh_out[:, t]
        ds = dc + dh * m * o * (1 - q * q)
        dz = np.concatenate([ds * g * i * (1 - i), ds * c0 * f * (1 - f), dh * q * o * (1 - o), ds * i * (1 - g * g)], axis=1) * m
        dz_all[:, t] = dz
        du += h0.T @ dz
        dh = dz @ u.T + dh * (1 - m)
        dc = m * ds * f + (1 - m) * dc
    return [x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * HIDDEN), du, dz_all.sum(axis=(0, 1))]


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x = np.zeros((len(rows), steps, rows[0].shape[1]), np.float32)
    mask = np.zeros((len(rows), steps), np.float32)
    for k, r in enumerate(rows):
        x[k, : len(r)], mask[k, : len(r)] = r, 1
    return x, mask


# --- training ----------------------------------------------------------------

# Names that layouts give to main text and to what stands around it.
_MAIN = ("article", "main", "div.content", "div.post", "div.entry", "div.article", "section.story", "div.text", "div.body")
_AROUND = {
    "top": ("header", "div.header", "div.banner", "div.masthead", "nav", "div.nav", "div.menu", "ul.menu", "div.breadcrumb", "div.navbar"),
    "side": ("aside", "div.sidebar", "div.side", "div.widget", "div.related", "aside.related", "div.share", "div.tags"),
    "notice": ("div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "div.notice", "div.cookie", "div.alert", "div.newsletter", "div.popup", "div.banner", "form", "form.search", "form.login", "form.subscribe"),
    "after": ("div.comments", "section.comments", "div.comment", "ol.commentlist", "div.replies", "div.disqus", "ul.comments"),
    "end": ("footer", "div.footer", "div.copyright", "footer.site", "div.bottom"),
}
_MARK = "\x01"
#: Pages that may say what their main text is.
_LABELLED = r"(?i)<(article|main)[\s>]"


def _wrap(rng: np.random.Generator, name: str, inner: str) -> str:
    tag, _, label = name.partition(".")
    extra = str(rng.choice(["", "", " x", "-box", "_wrap", "-1"])) if label else ""
    return f'<{tag} {rng.choice(["class", "class", "id"])}="{label}{extra}">{inner}</{tag}>' if label else f"<{tag}>{inner}</{tag}>"


def _imagined(rng: np.random.Generator, prose: list[str], others: list[str]) -> str:
    """A page in another layout; blocks of main text begin with a mark."""

    def some(texts: list[str], least: int, most: int) -> list[str]:
        return [entities.escape(texts[k]) for k in rng.integers(0, len(texts), rng.integers(least, most + 1))]

    def links(texts: list[str]) -> str:
        words = [t.split()[0] for t in texts]
        return "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words) + "</ul>"

    def around(kind: str) -> str:
        name = str(rng.choice(_AROUND[kind]))
        if kind == "after":
            inner = str(rng.choice(["", "<h3>Comments</h3>"])) + "".join(
                f'<div class="{rng.choice(["comment", "reply", "c"])}"><p>{t}</p></div>' if rng.random() < 0.6 else f"<p>{t}</p>" for t in some(prose, 1, 5)
            )
        elif name.startswith("form"):
            inner = "<label>" + some(others, 1, 1)[0] + "</label><input><button>" + some(others, 1, 1)[0].split()[0] + "</button>"
        elif rng.random() < 0.5:
            inner = links(some(others, 2, 8))
        else:
            tag = rng.choice(["p", "div", "span", "h4"])
            inner = "".join(f"<{tag}>{t}</{tag}>" for t in some(prose if rng.random() < 0.5 else others, 1, 3))
        return _wrap(rng, name, inner)

    def maybe(kind: str, p: float) -> str:
        return "".join(around(kind) for _ in range(rng.integers(1, 3))) if rng.random() < p else ""

    parts = [f"<h1>{_MARK}{some(others, 1, 1)[0]}</h1>"] if rng.random() < 0.8 else []
    for t in some(prose, 1, 12):
        tag = rng.choice(["p", "p", "p", "p", "div", "li", "blockquote", "h2", "td"], p=[0.2, 0.2, 0.2, 0.2, 0.06, 0.04, 0.03, 0.05, 0.02])
        inner = _MARK + t
        if rng.random() < 0.15:
            inner = f"<b>{inner}<br>"
        parts.append(f"<{tag}>{inner}</{tag}>" if rng.random() < 0.8 else f"<{tag}>{inner}")
        if rng.random() < 0.08:
            parts.append(around(str(rng.choice(["notice", "side"]))))
    inner = "".join(parts) + (maybe("after", 0.2) if rng.random() < 0.5 else "")
    page = maybe("top", 0.8) + maybe("notice", 0.6) + maybe("side", 0.3) + _wrap(rng, str(rng.choice(_MAIN)), inner)
    page += maybe("after", 0.4) + maybe("side", 0.4) + maybe("notice", 0.3) + maybe("end", 0.8)
    if rng.random() < 0.3:
        page = _wrap(rng, str(rng.choice(["div.container", "div.page", "div.wrapper", "div.site"])), page)
    return f"<html><head><title>{others[int(rng.integers(len(others)))]}</title></head><body>{page}</body></html>"


def _labelled(path: tuple[str, ...]) -> bool:
    """Inside an article or main element, and not in what may be nested in one."""
    at = min((path.index(n) for n in ("article", "main") if n in path), default=len(path))
    return at < len(path) and _NESTED.isdisjoint(path[at:])


def train(pages: list[str], seed: int = 7) -> Network | None:
    """Fits the network; None if no page has text. Pages without a labelled region are
    used only if no page has one."""
    rng = np.random.default_rng(seed)
    read = [blocks(p) for p in sorted(pages)]
    cases = []
    prose, others = [], []
    for page in read:
        inside = np.array([_labelled(b.path) for b in page], np.float32)
        if inside.any():
            cases.append((vectors(page), inside))
            for b, main in zip(page, inside, strict=True):
                (prose if main and len(b.text) > 80 else others).append(b.text)
    if not cases:
        for b in itertools.chain.from_iterable(read):
            (prose if len(b.text) > 80 and 2 * b.linked < len(b.text) else others).append(b.text)
        if not prose and not others:
            return None
        if not prose:
            raise ValueError("no page of the sample has a labelled region or a long text to learn from")
        others = others or [" ".join(t.split()[:3]) for t in prose]
    for _ in range(2 * SAMPLE if prose and others else 0):
        page = blocks(_imagined(rng, prose, others))
        goal = np.array([b.text.startswith(_MARK) for b in page], np.float32)
        for b in page:
            b.text = b.text.lstrip(_MARK)
        if len(page) and len([b for b in page if not b.text]) == 0:
            cases.append((vectors(page), goal))
    net = Network.new(rng)
    mean, square, step = [np.zeros_like(w) for w in net.w], [np.zeros_like(w) for w in net.w], 0
    for epoch in range(EPOCHS):
        order = sorted(range(len(cases)), key=lambda k: (len(cases[k][0]) + rng.integers(0, 6), k))
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        rng.shuffle(batches)
        for batch in batches:
            x, mask = _padded([cases[k][0] for k in batch])
            goal = _padded([cases[k][1][:, None] for k in batch])[0][:, :, 0]
            keep = rng.random((x.shape[0], 1, x.shape[2])) > 0.05
            x = np.where(keep, x, 0).astype(np.float32)
            step += 1
            for w, g, m, s in zip(net.w, net.gradients(x, mask, goal), mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = RATE * (1 - 0.9 * epoch / EPOCHS)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def label(net: Network, pages: list[list[Block]]) -> list[np.ndarray]:
    """Whether each block is main text. Pages of similar length are read together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        longest, to = len(pages[order[at]]), at
        while to < len(order) and to - at < 64 and len(pages[order[to]]) <= max(8, 1.3 * longest):
            if to > at and (to - at + 1) * len(pages[order[to]]) > BLOCKS:
                break
            to += 1
        part = order[at:to]
        x, mask = _padded([vectors(pages[k]) for k in part])
        for k, p in zip(part, net.run(x, mask)[0], strict=True):
            out[k] = p[: len(pages[k])] > 0.5
        at = to
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Network | None:
    """Trains on the first ``SAMPLE_CHARS`` characters of at most ``SAMPLE`` pages, those
    first in the order of a hash, of the pages with an article or main element there if
    there are any. (What is extracted comes from whole pages.)"""
    order = F.xxhash64(F.col(id_col).cast("string"), F.length(html_col))
    usable = pages.where(F.length(html_col) > 0).withColumns({html_col: F.substring(html_col, 1, SAMPLE_CHARS), "_order": order})
    labelled = F.col(html_col).rlike(_LABELLED)
    n, n_labelled = usable.agg(F.count("*"), F.count(F.when(labelled, 1))).first()
    if n_labelled:
        usable, n = usable.where(labelled), n_labelled
    # A part that follows from the count first: a task then sends the driver few pages.
    share = 4.0 * SAMPLE / max(1, n)
    part = usable.where(F.pmod("_order", F.lit(1 << 30)) / float(1 << 30) <= share)
    few = part.orderBy("_order", html_col).limit(SAMPLE)
    return train([r[0] for r in few.select(html_col).collect()])


def extract(pages: DataFrame, net: Network | None, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of any such column and of ``html_col``: the main
    text, one line per block in page order, empty if there is none.

    Missing and empty pages have no text, nor has any page without a trained network.
    Rows are independent of each other, so repeated ones have the same text; long pages
    are read whole."""
    inputs, at = pages.columns, pages.columns.index(html_col)
    names = [c for c in inputs if c not in (html_col, "text")]
    sent = pages.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                read = [blocks(p) for p in batch.column(at).to_pylist()]
                kept = label(sent.value, read) if sent.value else [np.zeros(len(b), bool) for b in read]
                text = ["\n".join(b.text for b, k in zip(page, keep, strict=True) if k) for page, keep in zip(read, kept, strict=True)]
                columns = {c: batch.column(k) for k, c in enumerate(inputs)}
                yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), pa.array(text, pa.string())], names=[*names, "text"])

    return pages.mapInArrow(run, T.StructType([pages.schema[n] for n in names] + [T.StructField("text", T.StringType())]))
