"""Removed words against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from indexloom.llm import substring


def brute(rows, window):
    words = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = []
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out)


def made(seed):
    """Shared passages at, under and over the window, copies, edited copies, inner repeats and a very common passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    run = lambda n: [word() for _ in range(n)]
    passages = [run(n) for n in (49, 50, 51, 60, 75, 140)]
    common = run(55)
    texts = []
    for _ in range(60):
        t = run(rng.randint(0, 90))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = word()
            at = rng.randint(0, len(t))
            t[at:at] = p
        if rng.random() < 0.4:
            t += common
        if texts and rng.random() < 0.2:
            t = rng.choice(texts).split()
            if rng.random() < 0.5 and t:
                t[rng.randrange(len(t))] = "Edit"
        texts.append(rng.choice([" ", "\n", "  "]).join(t))
    texts += [None, "", "the " * 130, "the " * 60, " \t\n"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, first string")
    got = sorted(map(tuple, substring.substring_dedup(spark, df).collect()))
    want = brute(rows, 50)
    assert got == want
    assert sum(r[2] for r in want) > 1000


def test_repeats_null_ids_text_and_empty_table(spark):
    t = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([(None, t, 1), (5, t, 2), (5, t, 3), (7, "x\n" + t, 4)], "doc_id long, text string, n_words long")
    got = {tuple(r) for r in substring.substring_dedup(spark, df, keep_text=True).select("doc_id", "n_removed", "kept_text").collect()}
    assert got == {(None, 0, t), (5, 0, t), (7, 70, "x")}
    assert substring.substring_dedup(spark, df.limit(0)).collect() == []


@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 20))
@settings(max_examples=60, deadline=None)
def test_sliding_min(x, width):
    if width <= len(x):
        assert substring.sliding_min(np.array(x), width).tolist() == [min(x[i : i + width]) for i in range(len(x) - width + 1)]
