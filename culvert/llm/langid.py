"""Language identification by the nearest of several centroids per language.

A text is the normalised TF-IDF vector of its letter n-grams (one to three letters,
hashed to a fixed number of places). The vectors of labelled texts are clustered per
language with spherical k-means; a text gets the language of the centroid with the
largest cosine, and is marked as rejected if that lies further off than the texts of
that language do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Places of a vector, n-gram lengths, and centroids per language.
PLACES, LENGTHS, CENTROIDS = 4096, (1, 2, 3), 4
#: Labelled texts used for fitting, per language and in all, and languages learned, the
#: most frequent ones.
PER_LANGUAGE, IN_ALL, LANGUAGES = 400, 8_000, 1_000
#: A text is rejected if its cosine is below this quantile of its language's own texts, less a margin.
REJECT_QUANTILE, REJECT_MARGIN = 0.01, 0.05
#: Characters looked at together; a longer text is counted in pieces that overlap.
PIECE = 1 << 18

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIER = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts(text: str | None) -> np.ndarray:
    """Hashed n-gram counts of a whole text, lower-cased; every run of other characters
    than letters counts as one blank."""
    total = np.zeros(PLACES, np.float64)
    blank = np.zeros(0, np.uint32)
    for at in range(0, len(text or ""), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where((codes >= 0xAA) | ((codes >= 97) & (codes <= 122)), codes, 32)
        codes = np.concatenate([blank, codes])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = codes[keep]
        for n in LENGTHS:
            grams = sum((codes[k : len(codes) - n + 1 + k].astype(np.uint64) + np.uint64(k << 20)) * _MULTIPLIER[k] for k in range(n))
            if len(codes) >= n:
                fresh = grams[max(0, len(blank) - n + 1) :]
                slots = ((fresh ^ (fresh >> np.uint64(15))) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(52)
                total += np.bincount(slots.astype(np.int64), minlength=PLACES)
        blank = codes[-(max(LENGTHS) - 1) :]
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # smallest accepted cosine, by language

    def vector(self, found: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(found) * self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        near = self.centroids @ self.vector(counts(text))
        best = int(np.argmax(near))
        score = min(1.0, max(0.0, float(near[best])))
        return self.languages[self.owner[best]], score, score < float(self.floor[self.owner[best]])


def _sample(labelled: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """At most ``PER_LANGUAGE`` rows per language and ``IN_ALL`` rows in all, by the hash
    of their ids: first by a threshold that follows from the counts, then by rank. All
    first rows come before any second one, so each language has its share of ``IN_ALL``."""
    sizes = labelled.groupBy(lang_col).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), lang_col).limit(LANGUAGES)
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit("fit"))
    share = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    few = labelled.join(F.broadcast(sizes), lang_col).where(share <= 2.0 * PER_LANGUAGE / F.col("_n") + 1e-9)
    ranked = few.withColumn("_rank", F.row_number().over(Window.partitionBy(lang_col).orderBy(order, id_col)))
    return ranked.where(F.col("_rank") <= PER_LANGUAGE).orderBy("_rank", lang_col, id_col).limit(IN_ALL)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits on a bounded sample of ``labelled``; rows without a language, without a
    letter or without an id are not learned from. With many languages each one has
    fewer rows; those beyond the ``LANGUAGES`` most frequent are left out. Without any
    row the model predicts ``und`` only."""
    usable = labelled.select(id_col, lang_col, text_col).dropna()
    chosen = _sample(usable.select(id_col, lang_col), id_col, lang_col).select(id_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(l.as_py(), counts(t.as_py()).astype(np.uint32).tobytes()) for l, t in zip(batch.column(0), batch.column(1), strict=True) if has_letter(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([l for l, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], names=["lang", "found"])

    # IN_ALL rows at most, so the texts stay where they are.
    texts = usable.join(F.broadcast(chosen), [id_col, lang_col], "left_semi").select(F.col(lang_col).cast("string"), F.col(text_col))
    rows = texts.mapInArrow(run, "lang string, found binary").collect()
    rows = sorted((r.lang, bytes(r.found)) for r in rows)
    names = sorted({l for l, _ in rows})
    if not rows:
        return Model([], np.ones(PLACES), np.zeros((0, PLACES)), np.zeros(0, np.int64), np.zeros(0))
    found = np.stack([np.frombuffer(c, np.uint32) for _, c in rows]).astype(np.float64)
    lang = np.array([names.index(l) for l, _ in rows])
    idf = np.log((1 + len(rows)) / (1 + (found > 0).sum(axis=0))) + 1
    vectors = _unit(np.sqrt(found) * idf)
    parts = [_cluster(vectors[lang == k]) for k in range(len(names))]
    centroids = np.concatenate(parts)
    owner = np.repeat(np.arange(len(names)), [len(p) for p in parts])
    floor = np.array([np.quantile((vectors[lang == k] @ parts[k].T).max(axis=1), REJECT_QUANTILE) for k in range(len(names))])
    return Model(names, idf, centroids, owner, floor - REJECT_MARGIN)


def _cluster(x: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; begins with the point nearest to the mean, then takes those
    furthest from the centres so far."""
    centres = [x[np.argmax(x @ _unit(x.mean(axis=0)))]]
    while len(centres) < min(CENTROIDS, len(x)):
        centres.append(x[np.argmin(np.max(x @ np.stack(centres).T, axis=1))])
    c = np.stack(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([_unit(x[own == k].sum(axis=0)) if (own == k).any() else c[k] for k in range(len(c))])
    return c


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` more (columns of those
    names are replaced), from the text alone.

    ``score`` is the cosine to the nearest centroid, from 0 to 1. Texts that are missing
    or have no letter get ``und``, score 0, and are rejected, as are all texts if nothing
    was learned. Rows are independent of each other; long texts are counted whole."""
    inputs, at = docs.columns, docs.columns.index(text_col)
    names = [c for c in inputs if c not in ("lang_pred", "score", "rejected")]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x centroids x places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(at)]
            columns = {c: batch.column(k) for k, c in enumerate(inputs)}
            new = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), *new], names=[*names, "lang_pred", "score", "rejected"])

    schema = T.StructType(
        [docs.schema[n] for n in names]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that is never learned from; rows without an id are not in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
