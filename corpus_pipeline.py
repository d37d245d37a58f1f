"""The corpus pipeline: five stages from raw documents to tokens.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is
written and read again as the next one's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm import bpe, decontaminate, lines, quality, simhash
from culvert.llm.frames import stored
from culvert.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines, with their new length."""
    cut = lines.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.one_per_group(docs, shingle=3, radius=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, folder, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    tokens = bpe.encode(docs, tokenizer_path(), decoded_col="text")
    names = [c for c in docs.columns if c not in ("text", "tokens", "n_tokens")]
    return tokens.select(*names, "tokens", F.size("tokens").cast("long").alias("n_tokens"), "text")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: SimHash groups, spaced seeds and BPE are beyond SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
