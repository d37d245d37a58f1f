"""The queries on the text tables, each a thin use of its operator, and SQL twins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm import (
    bpe, chat, decontaminate, embeddings, html_extract, langid, lines, phrases, quality, secrets, simhash, spelling, substrings,
)
from culvert.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES", "table", "tokenizer_path"]

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=3)


def op2_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", langid.held_out().alias("held_out"))
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality.verdicts(docs, carry=["doc_id"]).drop("_key", "_key2")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer_path(), decoded_col="decoded").select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = html_extract.extract(pages.select("page_id", "url", "html"), html_extract.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_agree", "n_window", "word_at")


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its formatted parts, read one after the other."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state: list | None = None

    def done(s: list) -> tuple:
        return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if state is None or r["part"] == 0:
                rows += [done(state)] if state else []
                state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text = r["formatted"]
            for role, said in chat.read_back(text):
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
            for span in r["loss"]:
                learned = chat.unescape(text[span["start"] : span["end"]])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(text)
        if rows:
            yield out(rows)
    if state:
        yield out([done(state)])


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.format_chat(turns).mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "text")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op13_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_langid, op3_quality, op4_bpe, op5_html, op6_secrets, op7_decontaminate, op8_substrings, op9_chat, op10_lines,
        op11_spelling, op12_phrases, op13_embeddings,
    )
}
