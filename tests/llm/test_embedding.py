"""Vector links against all pairs in double precision."""

import math

import numpy as np
import pytest

from indexloom.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, n long"


def brute(rows):
    good = {i: np.array(v, np.float64) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    root = {i: i for i, _ in rows}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in good.items():
        for b, y in good.items():
            if a < b and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.95:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((i, links[i], find(i), find(i) == i) for i in root)


def made(seed, dim=64, n=250):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n // 10):
        c = rng.standard_normal(dim)
        out.append(c)
        for _ in range(9):
            out.append((c / np.linalg.norm(c) + rng.standard_normal(dim) * rng.uniform(0, 0.05)) * rng.uniform(0.1, 5))
    vectors = [[float(np.float32(x)) for x in v] for v in out]
    vectors += [vectors[3], vectors[3], [-x for x in vectors[3]], None, [], [0.0] * dim, [float("nan")] * dim, [None] + [1.0] * (dim - 1), [1.0] * 3, [2.0] * 3, [float("inf")] + [1.0] * (dim - 1)]
    order = rng.permutation(len(vectors))
    return [(int(i), vectors[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("seed,dim,cell,axis", [(1, 64, 1 << 15, 1 << 14), (2, 64, 40, 10), (3, 10, 1 << 15, 10)])
def test_like_brute_force(spark, monkeypatch, seed, dim, cell, axis):
    monkeypatch.setattr(embedding, "CELL", cell)  # small cells are cut into chunks
    monkeypatch.setattr(embedding, "ONE_AXIS", axis)
    rows = made(seed, dim)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, embedding.near_dedup(spark, df).collect())) == brute(rows)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (9, [1.0, 2.1], 1)], SCHEMA)
    assert sorted(map(tuple, embedding.near_dedup(spark, df).collect()), key=str) == [(4, 1, 4, True), (9, 1, 4, False), (None, 0, None, True)]
    assert embedding.near_dedup(spark, df.limit(0)).collect() == []
