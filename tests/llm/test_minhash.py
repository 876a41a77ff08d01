"""Near-duplicate components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from indexloom.llm import minhash

DOCS = "doc_id long, text string, lang string, n_shingles long"


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent=80):
    sets = {d: shingle_set(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((d, len(sets[d]), find(d), d == find(d)) for d in sets)


def made(seed, n_base=6, copies=12):
    """Bases with copies at many distances, chains of small edits, exact copies and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    texts = []
    for _ in range(n_base):
        base = [word() for _ in range(rng.randint(3, 80))]
        texts.append(" ".join(base))
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, 1 + len(t) // 8)):
                t[rng.randrange(len(t))] = word()
            texts.append("\t".join(t) if rng.random() < 0.3 else " ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
        chain = list(base)
        for _ in range(8):
            chain[rng.randrange(len(chain))] = word()
            texts.append("  ".join(chain) + "\n")
    texts += ["", None, "one", "ONE", "two words", "Two words", " ", "é ü", "É ü"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,k,chunk", [(1, 2, 2048), (2, 5, 5), (3, 2, 3)])
def test_like_brute_force(spark, monkeypatch, seed, k, chunk):
    monkeypatch.setattr(minhash, "CHUNK_MEMBERS", chunk)
    rows = made(seed)
    df = spark.createDataFrame([(d, t, None, 7) for d, t in rows], DOCS)
    got = sorted(tuple(r) for r in minhash.near_dedup(spark, df, k).collect())
    assert got == brute(rows, k)


def test_repeats_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c", "x", 1), (1, "a b c", None, 1), (1, "a b c", None, 1), (None, None, None, None)], DOCS)
    got = sorted(map(tuple, minhash.near_dedup(spark, df, 2).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=str)
    assert minhash.near_dedup(spark, df.limit(0), 2).collect() == []


def test_signatures_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(5)
    seen = []
    for _ in range(300):
        x = rng.integers(0, 2**63, size=30, dtype=np.uint64)
        e, d = np.r_[x[:20], x[10:]], np.r_[np.zeros(20, int), np.ones(20, int)]
        s = minhash.superminhash(e, d, 2)
        seen.append((s[0] == s[1]).mean())
    assert abs(np.mean(seen) - 1 / 3) < 0.01
    assert np.std(seen) < (1 / 3 * 2 / 3 / 128) ** 0.5


def test_long_text(spark):
    text = "w%d " * 30_000 % tuple(range(30_000))
    df = spark.createDataFrame([(2, text, None, 0), (1, text + "end", None, 0)], DOCS)
    assert sorted(map(tuple, minhash.near_dedup(spark, df, 5).collect())) == [(1, 29_997, 1, True), (2, 29_996, 1, False)]


def test_one_id_with_several_texts(spark):
    """Texts under one id are one node, so what links with either is linked with both."""
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    near = lambda t: t + " end"
    df = spark.createDataFrame([(5, a, None, 0), (5, b, None, 0), (1, a, None, 0)], DOCS)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_dedup(spark, df, 2).collect()} == {(5, 1, False), (1, 1, True)}
    df = spark.createDataFrame([(5, a, None, 0), (5, b, None, 0), (7, near(b), None, 0), (8, near(a), None, 0), (5, "", None, 0), (6, "", None, 0)], DOCS)
    assert {(r["doc_id"], r["component_id"]) for r in minhash.near_dedup(spark, df, 2).collect()} == {(5, 5), (7, 5), (8, 5), (6, 6)}


@pytest.mark.parametrize("k", [2, 5])
def test_whole_table_like_brute_force(spark, k):
    """Recall over a whole table: every document's component is that of all its links."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in minhash.near_dedup(spark, docs, k).collect()) == brute(rows, k)
