"""Documents that try the operators: nulls, blanks, repeats, long texts, clashing names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ("_row", "_row_id", "_row_text", "fp", "root", "mark", "start", "starts", "note", "bucket", "symbol_share", "_lang", "n", "lang_x", "lines")


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(["th", "er", "an", "in", "re", "ß", "ón"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    shared = " ".join(words(rng, 60))
    passage = "\n".join(" ".join(words(rng, 8)) for _ in range(4))
    prose = [" ".join(words(rng, rng.randint(1, 90))) for _ in range(12)]
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n \x0b\x0c\r "),
        (4, "one"),
        (5, prose[0] + "\n" + passage + "\n" + prose[1]),
        (5, prose[0] + "\n" + passage + "\n" + prose[1]),
        (5, prose[2] + " " + shared),
        (None, shared + "\n" + prose[3]),
        (None, shared + "\n" + prose[3]),
        (None, None),
        (6, "\n".join([prose[4], passage, "", " ", passage, prose[5]])),
        (7, "spam " * 400),
        (8, " ".join(words(rng, 30_000)) + " " + shared),
        (9, "  " + shared.replace(" ", "  \n ") + "\n"),
        (10, "x" * 70_000),
        (11, "a b c \U0001f600 Ünï<|endoftext|>  code\n\n"),
    ]
    texts += [(20 + k, f"{p}\n{passage if k % 2 else shared}") for k, p in enumerate(prose)]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s", None]), None) for i, t in texts]


def documents(spark, data: list[tuple] | None = None, clashes: bool = True):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if clashes:
        df = df.withColumns({c: F.lit(f"kept {c}") for c in CLASHES})
    return df.repartition(3)
