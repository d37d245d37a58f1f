"""Quality rules with thresholds that follow the corpus.

All measures are integers. Per language and source, a sketch holds how many documents
fall into each bucket of a measure; buckets keep a value's leading binary digits, so a
sketch has a bounded number of buckets, its quantiles are at most 1/32 off, and
sketches merge by adding counts: those of a language's sources make the language's,
all languages' make the corpus'. The bounds of a language are the outer quantiles of its
sketch, averaged with the corpus' as if these came from ``PRIOR`` documents more; those
of a group are averaged with its language's in the same way. So a group of a few
documents goes by its language, one of many by itself, with no step between. A document
goes if a measure lies beyond the bounds.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culvert.llm.frames import ROW, stored

#: Words are parted, and lines judged blank, by this white space.
_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"

#: Base rules.
LEAST_WORDS, MOST_REPEATED = 10, 20
_SPAN = 5

#: Measures per document, and whether unusually low values count as well.
MEASURES = {"symbol_share": False, "dup_line_share": False, "repeat_share": False, "word_length": True}
#: Documents of a thousand beyond an outer quantile.
TAIL = 10
#: Documents as which a language's bounds count in its groups, and the corpus' in languages.
PRIOR = 200
#: Binary digits that a bucket keeps.
_DIGITS = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _repeated_words(words: Column) -> Column:
    """Words in windows of five that occur twice or more."""

    def of(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (_SPAN - 1))
        hashes = F.transform(starts, lambda k: F.xxhash64(F.slice(words, k, _SPAN)))
        return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact(words)))

    def exact(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (_SPAN - 1))
        windows = F.transform(starts, lambda k: F.struct(F.array_join(F.slice(words, k, _SPAN), " ").alias("w"), k.alias("k")))
        return _let(F.sort_array(windows), covered)

    def covered(windows: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            same_before = (k > 0) & (F.get(windows, k - 1)["w"] == x["w"])
            return F.coalesce(same_before, F.lit(False)) | F.coalesce(F.get(windows, k + 1)["w"] == x["w"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(windows, twice), lambda x: x["k"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-_SPAN).alias("last"))
        return F.aggregate(
            places,
            zero,
            lambda acc, k: F.struct((acc["n"] + F.least(F.lit(_SPAN), k - acc["last"])).alias("n"), k.alias("last")),
            lambda acc: acc["n"],
        )

    return F.when(F.size(words) < _SPAN + 1, 0).otherwise(_let(words, of))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows as structs ``_row``, with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``. A missing text has no words."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    text = F.coalesce(F.col(ROW)[text_col].cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    counts = _let(
        _words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("r")),
    )
    out = rows.withColumn("_counts", counts).withColumns(
        {
            "n_words": F.col("_counts.n"),
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": F.col("_counts.r"),
            "_lines": F.size(lines).cast("long"),
        }
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_counts")


def _shares() -> dict[str, Column]:
    """The measures: parts of a thousand, and tenths of a character per word."""

    def share(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"(`{part}` * {scale}) div greatest(`{whole}`, 1)")

    return {
        "symbol_share": share("n_symbols", "word_chars", 1000),
        "dup_line_share": share("n_dup_lines", "_lines", 1000),
        "repeat_share": share("n_repeat_words", "n_words", 1000),
        "word_length": share("word_chars", "n_words", 10),
    }


def _bucket(value: Column) -> Column:
    """The value with all but its leading binary digits set to 0."""
    spare = F.greatest(F.length(F.bin(value)) - _DIGITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def sketches(measures: DataFrame) -> DataFrame:
    """``(lang, source, measure, bucket, n)``: the sketch of each group, from rows with
    the measures, ``_lang`` and ``_source``, without those that fail the base rules.
    Counted before any row is shuffled. A filter would compute the measures twice."""
    each = F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket")) for m in MEASURES])
    return (
        measures.select("_lang", "_source", F.explode(F.when(~F.col("base_failed"), each)).alias("m"))
        .groupBy("_lang", "_source", "m.measure", "m.bucket")
        .agg(F.count("*").alias("n"))
    )


def _outer(sketch: DataFrame, *by: str) -> DataFrame:
    """Per group and measure the number of documents and the outer quantiles."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")  # as many rows as a sketch has buckets
    ranked = merged.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "all": F.sum("n").over(group)})

    def quantile(permille: int) -> Column:
        return F.min(F.when(F.col("upto") * 1000 >= F.col("all") * permille, F.col("bucket")))

    return ranked.groupBy(*by, "measure").agg(
        F.max("all").alias("n"), quantile(TAIL).alias("low"), quantile(1000 - TAIL).alias("high")
    )


def _averaged(own: DataFrame, wider: DataFrame, on: list[str]) -> DataFrame:
    """The bounds of ``own`` with those of ``wider`` as from ``PRIOR`` documents more."""
    other = wider.select(*on, F.col("low").alias("low_w"), F.col("high").alias("high_w"))
    both = own.join(other, on)
    new = {b: F.expr(f"({b} * n + {b}_w * {PRIOR}) div (n + {PRIOR})") for b in ("low", "high")}
    return both.withColumns(new).drop("low_w", "high_w")


def thresholds(measures: DataFrame) -> DataFrame:
    """Bounds per ``_lang`` and ``_source`` of the rows that pass the base rules, two
    columns for each measure; the buckets of accepted values lie between them, ends
    included. Of measures that count only if unusually high, ``low`` is not applied."""
    sketch = sketches(measures)
    language = _averaged(_outer(sketch, "_lang"), _outer(sketch), ["measure"])
    bounds = _averaged(_outer(sketch, "_lang", "_source"), language, ["_lang", "measure"])
    wide = [F.max(F.when(F.col("measure") == m, F.col(b))).alias(f"{b}_{m}") for m in MEASURES for b in ("low", "high")]
    return bounds.groupBy("_lang", "_source").agg(*wide)


def _known(col: str) -> Column:
    """A group's name; missing ones form a group of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(ROW)[col].cast("string")), F.lit(""))


_NEW = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def verdicts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: Sequence[str] = ()
) -> DataFrame:
    """``(_key, _key2, carry..., measures, base_failed, kept)``, one row per row of
    ``docs``, without its text. The measures are computed once and stored; the keys are
    two hashes of text, language and source, on which alone a verdict depends."""
    parts = [F.col(ROW)[c] for c in (text_col, lang_col, source_col)]
    rows = measured(docs, text_col).withColumns(
        _shares()
        | {"_lang": _known(lang_col), "_source": _known(source_col)}
        | {"_key": F.xxhash64(*parts), "_key2": F.xxhash64(F.lit(_DIGITS), *parts)}
        | {f"_carry_{c}": F.col(ROW)[c] for c in carry}
    )
    kept = stored(rows.drop(ROW, "_lines"), "measures")
    inside = F.lit(True)
    for m, both in MEASURES.items():
        inside = inside & (_bucket(F.col(m)) <= F.col(f"high_{m}"))
        if both:
            inside = inside & (_bucket(F.col(m)) >= F.col(f"low_{m}"))
    # Stored, so Spark knows how few bounds there are and need not deal the rows by group.
    bounds = stored(thresholds(kept), "thresholds")
    out = kept.join(bounds, ["_lang", "_source"], "left").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    )
    return out.select("_key", "_key2", *[F.col(f"_carry_{c}").alias(c) for c in carry], *_NEW)


def _keyed(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    parts = [F.col(ROW)[c] for c in (text_col, lang_col, source_col)]
    return whole.withColumns({"_key": F.xxhash64(*parts), "_key2": F.xxhash64(F.lit(_DIGITS), *parts)})


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` with the measures of ``measured``, ``base_failed`` and ``kept`` more.

    ``kept`` is false for documents that fail the base rules, and for those with a
    measure beyond the outer quantiles of their language and source; values in the same
    bucket as a bound stay. The quantiles come from all documents that pass the base
    rules; a missing language or source is a group of its own. Repeated rows count as
    often as they occur; ids are not used. Columns of the same names as the new ones
    are replaced. An empty table gives no rows.
    """
    found = verdicts(docs, text_col, lang_col, source_col).dropDuplicates(["_key", "_key2"])
    out = _keyed(docs, text_col, lang_col, source_col).join(found, ["_key", "_key2"])
    return out.select(*[F.col(ROW)[c].alias(c) for c in docs.columns if c not in _NEW], *_NEW)


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps."""
    found = verdicts(docs, text_col, lang_col, source_col).where("NOT kept").select("_key", "_key2").distinct()
    out = _keyed(docs, text_col, lang_col, source_col).join(stored(found, "rejected"), ["_key", "_key2"], "left_anti")
    return out.select(*[F.col(ROW)[c].alias(c) for c in docs.columns])
