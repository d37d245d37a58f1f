"""The registered queries and the pipeline on the test tables."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from culvert.llm import components as cc
from culvert.llm import decontaminate, html_extract, langid, quality, simhash
from culvert.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: r.doc_id)


def run(spark, key):
    return queries()[key](spark, FOLDER).collect()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_op1(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op1_simhash")}
    prints = [brute.fingerprint(r.text) for r in docs]
    roots = brute.components(prints)
    for r, p, root in zip(docs, prints, roots):
        assert got[r.doc_id].fingerprint == f"{p:016x}" and got[r.doc_id].component_id == docs[root].doc_id


def test_op2(spark, docs):
    lang = {r.doc_id: r.lang for r in docs}
    got = run(spark, "op2_langid")
    held = [r for r in got if r.held_out]
    assert len(got) == len(docs) and held
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_op3(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op3_quality")}
    for r in docs:
        assert tuple(got[r.doc_id])[1:7] == brute.quality(r.text)
    clean = [r for r in docs if not got[r.doc_id].base_failed and not got[r.doc_id].n_symbols and not got[r.doc_id].n_dup_lines]
    assert all(got[r.doc_id].kept for r in clean)


def test_op4(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r for r in run(spark, "op4_bpe")}
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
        assert tuple(got[r.doc_id])[1:] == expected


def test_op5(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in run(spark, "op5_html"):
        inside = [b.text for b in html_extract.blocks(pages[r.page_id].html) if "article" in b.path]
        assert r.text == "\n".join(inside) and r.n_chars == len(r.text)


def test_op6(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op6_secrets")}
    assert all(got[r.doc_id].base_sha256 == sha(brute.secrets(r.text)) for r in docs)


def test_op7(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    vocabulary = [set(brute.plain_words(i.text)) for i in items]
    expected = set()
    for r in docs:
        words = set(brute.plain_words(r.text))
        for i, v in zip(items, vocabulary):
            if len(words & v) >= 5 and brute.leaks(r.text, i.text, decontaminate._TOLERATED):
                expected.add((r.doc_id, i.item_id))
    assert {(r.doc_id, r.item_id) for r in run(spark, "op7_decontaminate")} == expected


def test_op8_and_op10(spark, docs):
    texts = [r.text or "" for r in docs]
    got = {r.doc_id: r for r in run(spark, "op8_substrings")}
    for r, (text, n, gone) in zip(docs, brute.cut_words(texts)):
        assert tuple(got[r.doc_id])[1:] == (n, gone, sha(text))
    got = {r.doc_id: r for r in run(spark, "op10_lines")}
    for r, (text, n, gone) in zip(docs, brute.cut_lines(texts)):
        assert (got[r.doc_id].text, got[r.doc_id].n_lines, got[r.doc_id].n_removed) == (text, n, gone)


def test_op9(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect()
    said = "</s>[INST] ok [/INST]"
    by = {-7: [("user", said), ("assistant", said)]}
    for t in turns:
        by.setdefault(t.conv_id, []).append((t.role, t.text or ""))
    got = {r.conv_id: r for r in run(spark, "op9_chat")}
    assert set(got) == set(by)
    for conv, own in by.items():
        learned = "".join(t for r, t in own if r == "assistant")
        expected = (len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(learned), sha(learned))
        assert tuple(got[conv])[1:5] == expected


def test_pipeline(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_tokens"]
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r.doc_id for r in quality.judge(table).where("kept").collect()}
    left = [r for r in docs if r.doc_id in kept]
    cut = [t for t, _, _ in brute.cut_lines([r.text or "" for r in left])]
    roots = brute.components([brute.fingerprint(t) for t in cut])
    left = [(r, t) for k, (r, t) in enumerate(zip(left, cut)) if roots[k] == k]
    items = [i.text for i in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    vocabulary = [set(brute.plain_words(i)) for i in items]

    def leaked(t):
        words = set(brute.plain_words(t))
        return any(len(words & v) >= 5 and brute.leaks(t, i, decontaminate._TOLERATED) for i, v in zip(items, vocabulary))

    expected = {r.doc_id: t for r, t in left if not leaked(t)}
    got = {r.doc_id: r for r in run(spark, "pipeline")}
    assert set(got) == set(expected)
    assert all(got[k].text == t and got[k].n_chars == len(t) and got[k].n_tokens == len(got[k].tokens) for k, t in expected.items())


def test_stages_return_the_columns_of_documents(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table.limit(0), FOLDER).columns == table.columns


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(0, 200)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (2000, 1999), (1999, 2000)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in cc.components(links).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1200)} | {1999: 1999, 2000: 1999}


def test_tiles_find_all_links(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = base[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    values = np.unique(np.concatenate([base, near, near ^ np.uint64(0b101), np.array([0, 1, 7, 2**64 - 1], np.uint64)]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    expected = brute.components(values.tolist())
    for tile in (4, 2048):
        links = cc.components(simhash.links(frame, 3, tile)).collect()
        root = {r.node: r.root for r in links}
        signed = values.view(np.int64).tolist()
        groups = {}
        for v, e in zip(signed, expected):
            groups.setdefault(root.get(v, v), set()).add(e)
        assert len(groups) == len(set(expected)) and all(len(g) == 1 for g in groups.values())


def test_quality_ranges_follow_the_group(spark):
    base = spark.range(1000).select(
        F.lit("=en").alias("_lang"), F.when(F.col("id") < 700, "=a").otherwise("=b").alias("_source"),
        F.when(F.col("id") < 700, F.col("id") % 4).otherwise(400 + F.col("id") % 4).alias("symbol_share"),
        F.lit(False).alias("base_failed"),
        *[F.lit(50).cast("long").alias(m) for m in ("dup_line_share", "repeat_share", "word_length")],
    )
    got = {r._source: r for r in quality.thresholds(base).collect()}
    assert got["=a"].high_symbol_share < 100 and got["=b"].low_symbol_share > 200


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(50).select(F.col("id").alias("doc_id"), langid.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(langid.held_out()).first()[0] is False


def test_fit_uses_a_bounded_sample(spark):
    big = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    n = langid._sample(big, "doc_id", "lang").count()
    assert 0 < n <= langid.PER_LANGUAGE


def test_fit_learns_every_language_within_the_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "IN_ALL", 60)
    monkeypatch.setattr(langid, "PER_LANGUAGE", 20)
    rows = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "zh").otherwise(F.concat(F.lit("l"), F.col("id") % 20)).alias("lang"),
        F.lit("some words").alias("text"),
    )
    sizes = {r.lang: r["count"] for r in langid._sample(rows, "doc_id", "lang").groupBy("lang").count().collect()}
    assert len(sizes) == 11 and sum(sizes.values()) == 60 and max(sizes.values()) - min(sizes.values()) <= 1
    assert "zh" in langid.fit(rows).languages
