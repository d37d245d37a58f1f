"""Spelling variants, phrases and near-duplicate vectors against the long way."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import edge
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from culvert.llm import embeddings, phrases, queries, spelling

SMALL = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- spelling variants ---------------------------------------------------------


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced, tried one by one."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def vocabulary(rows, least=7, seen=2, noise=31):
    found = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if noise and h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                found[w] += 1
    return {w: n for w, n in found.items() if n >= seen}


def grouped(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words}


def got_variants(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_variants_of_whole_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    words = vocabulary(rows)
    # Words one edit apart share a deletion, or one is a deletion of the other.
    cut = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            cut[w[:k] + w[k + 1 :]].add(w)
        cut[w].add(w)
    near = {w: set().union(*(cut[x] for x in [w, *(w[:k] + w[k + 1 :] for k in range(len(w)))])) for w in words}
    got = got_variants(queries.op11_spelling(spark, SMALL))
    assert set(got) == set(words)
    for w, (form, _, n, n_near, form_n) in got.items():
        vs = [v for v in near[w] if one_edit(w, v)]
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        chosen = best if best and words[best] >= 10 * words[w] else None
        assert (form, n, n_near, form_n) == (chosen, words[w], len(vs), words[chosen] if chosen else None)


def chained():
    """A chain of forms, ties, a hot first half, and words of all lengths."""
    rng = random.Random(5)
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 250, "aaaabbb": 2600, "tiedword": 2, "tiedwora": 30, "tiedworb": 30, "ünïcodé": 2, "ünïcodée": 25}
    hot = {"prefixed" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(300)}
    some = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(250)}
    for w in sorted(hot | some):
        counts.setdefault(w, rng.choice([2, 2, 3, 40]))
    return counts


@pytest.mark.parametrize("tile", [spelling.TILE, 8])
def test_variants_chains_ties_and_hot_keys(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    counts = chained()
    text = " ".join(f"{w} " * n for w, n in counts.items())
    extra = [(2, None, None, None, None), (3, "", None, None, None), (None, "Aaaaaaa short aaaaaaa1 " + "x" * 5000 + " " + "x" * 5001, None, None, None), (4, "x" * 5000 + "." + "x" * 5001, None, None, None)]
    rows = [(1, text, None, None, None), *extra, extra[1]]
    docs = edge.documents(spark, rows)
    words = vocabulary([r[:2] for r in rows], noise=0)
    assert words["x" * 5000] == 2 and words["aaaaaaa"] == 4
    got = got_variants(spelling.variants(docs, noise=0))
    assert got == grouped(words)
    assert got["aaaaaaa"][:2] == ("aaaaaab", "aaaaaab") or got["aaaaaab"][1] == "aaaabbb"
    assert got["tiedword"][0] == "tiedwora"


def test_variants_noise_and_empty_tables(spark):
    rows = [(k, "Someword another " * 3, None, None, None) for k in range(200)] + [(None, "Someword " * 3, None, None, None)]
    got = got_variants(spelling.variants(edge.documents(spark, rows)))
    words = vocabulary([r[:2] for r in rows])
    assert got == grouped(words) and any(len(w) == 7 for w in got)
    assert spelling.variants(edge.documents(spark, [])).collect() == []
    assert spelling.variants(edge.documents(spark, [(1, "one two", None, None, None)])).count() == 0


# --- phrases -------------------------------------------------------------------


def counted(rows, longest=5):
    n, f = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                f.update(("und" if lang is None else lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return n, f


def best_phrases(rows, least, best, share=100):
    n, f = counted(rows)
    often = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    inside = defaultdict(int)
    for (lang, words), a in often.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    inside[lang, words[i:j]] = max(inside[lang, words[i:j]], a)
    out = defaultdict(list)
    for (lang, words), a in often.items():
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        if 100 * inside[lang, words] < share * a:
            out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    return {
        (lang, rank, p.decode(), -a, l, r, m, -s)
        for lang, found in out.items()
        for rank, (s, a, p, l, r, m) in enumerate(sorted(found)[:best], 1)
    }


def got_phrases(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def phrase_rows():
    rng = random.Random(7)
    pool = ["the", "red", "House", "of", "cards", "naïve", "straße", "a|b", "x y"]
    made = []
    for k in range(400):
        words = [rng.choice(pool) if rng.random() < 0.6 else f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", " "]) for w in words)
        made.append((k, text, rng.choice(["en", "de", None, ""]), None, None))
    made += [(500, "spam " * 3000, "en", None, None), (501, "a b " * 500 + "!", "en", None, None)]
    passage = " ".join(f"p{k}" for k in range(30))
    made += [(600 + k, f"{passage} end{k}", "fr", None, None) for k in range(12)]
    return made + [(None, None, "en", None, None), (7, "", "en", None, None), (8, " \t. , ", "en", None, None), made[3], made[3]]


@pytest.mark.parametrize("least, best, share", [(5, 50, 100), (2, 2000, 70), (12, 3, 100)])
def test_phrases(spark, least, best, share):
    rows = phrase_rows()
    got = got_phrases(phrases.collocations(edge.documents(spark, rows), least=least, best=best, share=share))
    assert got == best_phrases([(r[1], r[2]) for r in rows], least, best, share)


@pytest.mark.parametrize("trigger, most, bits", [(1, 64, 1 << 26), (10**9, 7, 1 << 26), (3, 5, 64)])
def test_phrases_whatever_the_chunks_and_maps(spark, trigger, most, bits):
    """A map of 64 bits lets nearly all through."""
    rows = phrase_rows()
    got = got_phrases(phrases.collocations(edge.documents(spark, rows), least=4, trigger=trigger, most=most, bits=bits))
    assert got == best_phrases([(r[1], r[2]) for r in rows], 4, 2000)


def test_phrase_chunks_share_passages_and_count_overlaps_once(spark):
    passage = " ".join(f"p{k}" for k in range(300))
    docs = edge.documents(spark, [(k, f"{passage}. other{k}", "en", None, None) for k in range(50)])
    dictionary = phrases.chunks(docs).collect()
    assert sum(r.own * r.freq for r in dictionary) == 50 * 301
    assert len(dictionary) < 50 + 60  # each copy of the passage has the same chunks
    assert phrases.collocations(edge.documents(spark, [])).collect() == []


def test_partial_counts_are_added_up_in_the_task():
    def part(*rows):
        lang, phrase, words, n = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(phrase), pa.array(words, pa.int32()), pa.array(n, pa.int64())], ["lang", "phrase", "words", "n"])

    rng = random.Random(5)
    parts = [part(*[(rng.choice("xy"), f"{rng.randrange(30)} b", 2, k) for k in range(rng.randrange(1, 90))]) for _ in range(40)]
    expected = Counter()
    for p in parts:
        for r in p.to_pylist():
            expected[r["lang"], r["phrase"], r["words"]] += r["n"]
    for most in (1, 1000, 1 << 20):
        got = [r for b in phrases._added(iter(parts), most) for r in b.to_pylist()]
        total = Counter()
        for r in got:
            total[r["lang"], r["phrase"], r["words"]] += r["n"]
        assert total == expected and (most < 1 << 20 or len(got) == len(expected))
    assert list(phrases._added(iter([]))) == []


def test_partial_counts_follow_the_tasks_not_the_files(spark):
    tasks = phrases.TASKS * spark.sparkContext.defaultParallelism
    rows = [("en", f"one two three four five{k}", 5, 1) for k in range(tasks * 4)]
    dictionary = spark.createDataFrame(rows, "lang string, chunk string, own int, freq long").repartition(tasks * 4)
    every = np.full(1, -1, np.int64).view(np.uint64)
    found = phrases._partial(dictionary, lambda p: phrases._words(p, every)).groupBy("phrase").agg(F.count("*").alias("parts"), F.sum("n").alias("n"))
    got = {r.phrase: r for r in found.collect()}
    assert len(got) == 4 + len(rows) and got["one"].n == len(rows) and got["one"].parts <= tasks


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 4 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 10**12 + 7)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 9 * 10**14 + 1)], "lang string, n long")
    row = phrases._scored(counts, totals).first()
    assert row.score == 1000 * (10**12 + 7) * (9 * 10**14 + 1) // (12 * 10**24)


# --- near-duplicate vectors ----------------------------------------------------


def long_way(rows, cosine=0.9):
    """Links and components of (id, vector) rows, all pairs compared."""
    dims = max((len(v) for _, v in rows if v), default=0)
    valid, unit = [], []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.zeros(dims)
            x[: len(v)] = np.array(v, np.float64) / max(map(abs, v))
            valid.append(k)
            unit.append(x / np.sqrt((x * x).sum()))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    x = np.array(unit).reshape(-1, dims)
    for i, k in enumerate(valid):
        for j in np.flatnonzero(x @ x[i] >= cosine):
            if j != i:
                links[k] += 1
                a, b = find(k), find(valid[j])
                root[max(a, b)] = min(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k)), i == least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("x") for c in ("uid", "n", "ball", "leaf", "root", "h1", "label")}).repartition(3)


def near_copies(rng, centre, count, spread):
    x = centre + rng.normal(size=(count, len(centre))) * spread * np.linalg.norm(centre) / math.sqrt(len(centre))
    return x.astype(np.float32)


def odd_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16)).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(base)]
    rows += [(100 + k, [float(x) for x in v]) for k, v in enumerate(near_copies(rng, base[0], 30, 0.05))]
    rows += [(200 + k, [float(3 * x) for x in base[1]]) for k in range(5)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [1.0, None]), (304, [float("nan")] * 16), (305, [float("inf")] + [1.0] * 15)]
    rows += [(306, [1.0]), (307, [2.0, 0.0, 0.0]), (None, [float(x) for x in base[2]]), (None, [-7.0] * 16), (None, None), rows[5], rows[5]]
    return rows


def test_odd_vectors(spark):
    rows = odd_rows()
    assert found(embeddings.near_duplicates(vectors(spark, rows))) == long_way(rows)
    assert embeddings.near_duplicates(vectors(spark, [])).collect() == []
    assert found(embeddings.near_duplicates(vectors(spark, [(1, None)]))) == [(1, 0, 1, True)]


def test_vectors_of_any_size(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300]), (4, [5e-324, 0.0]), (5, [1.0, 0.4])]
    assert found(embeddings.near_duplicates(vectors(spark, rows, "double"))) == long_way(rows)


@pytest.mark.parametrize("leaf, block", [(24, 10), (64, 10**6)])
def test_trees_blocks_and_balls_lose_no_link(spark, monkeypatch, leaf, block):
    """Groups of copies large enough for balls, in leaves cut into blocks."""
    monkeypatch.setattr(embeddings, "LEAF", leaf)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(9)
    parts = [rng.normal(size=(300, 24)).astype(np.float32)]
    parts += [near_copies(rng, c, size, 0.1) for c, size in zip(rng.normal(size=(4, 24)), (300, 40, 12, 5))]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(np.concatenate(parts))]
    got = found(embeddings.near_duplicates(vectors(spark, rows)))
    assert got == long_way(rows)


def test_recall_at_the_threshold():
    """Pairs at a cosine of just 0.9 share a leaf about as often as promised, closer ones always."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]

    def at(cosine, k):
        side = rng.normal(size=x[:k].shape)
        side -= (side * x[:k]).sum(axis=1)[:, None] * x[:k]
        return cosine * x[:k] + math.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1)[:, None]

    forest = embeddings.fit(x, len(x))
    assert len(forest.trees) > 2

    def met(other):
        out = np.zeros(len(other), bool)
        for tree in forest.trees:
            a = set(zip(*(v.tolist() for v in tree.leaves(x[: len(other)]))))
            for row, path in zip(*tree.leaves(other)):
                out[row] |= (row, path) in a
        return out.mean()

    assert met(at(0.9, 2000)) >= 0.92 and met(at(0.95, 2000)) >= 0.98 and met(at(0.99, 2000)) >= 0.999
    sizes = np.bincount(np.unique(forest.trees[0].leaves(x)[1], return_inverse=True)[1])
    assert sizes.max() < 4 * embeddings.LEAF


def test_leaves_below_the_sample_stay_small():
    """A forest fitted on few vectors parts many more of them."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60_000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    forest = embeddings.fit(x[:600], len(x))
    row, path = forest.trees[0].leaves(x)
    sizes = np.bincount(np.unique(path, return_inverse=True)[1])
    assert len(set(row.tolist())) == len(x) and sizes.mean() < 2 * embeddings.LEAF and sizes.max() < 12 * embeddings.LEAF


def test_embeddings_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(queries.op13_embeddings(spark, "/root/testdata/sf0.01")) == long_way(rows)
