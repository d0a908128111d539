"""Centroid clustering against plain k-means in Python's integers."""

import hashlib
import math
import random

import numpy as np

from ligaspark.llm import centroids, queries


def plain(rows, k=8, dims=64, rounds=10):
    """[(id, cluster, distance, cluster inertia, inertia, digest)] of rows (id, vector)."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), n) for n, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        best = assign()
        for n in range(len(c)):
            own = [v for (_, v), (_, b) in zip(kept, best, strict=True) if b == n]
            if own:
                c[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    best = assign()
    inertia = [sum(d for d, b in best if b == n) for n in range(len(c))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return [(i, b, d, inertia[b], sum(inertia), digest[b]) for (i, _), (d, b) in zip(kept, best, strict=True)]


def run(spark, monkeypatch, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, distance double")
    monkeypatch.setattr(queries, "table", lambda *a: df)
    return sorted(map(tuple, queries.op12_clusters(spark, "").collect()), key=repr)


def some(seed, n):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, 64))
    x = (middle[rng.integers(0, 5, n)] + rng.normal(scale=0.4, size=(n, 64))).astype(np.float32)
    return [(i, [float(a) for a in v]) for i, v in enumerate(x)]


def test_against_plain(spark, monkeypatch):
    rows = some(1, 120)
    rows += [rows[0], rows[0], (3, rows[9][1]), (None, rows[4][1]), (500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [1.0] * 63 + [None]), (505, [float("nan")] * 64), (506, [float("inf")] + [0.0] * 63)]
    rows += [(600 + i, [0.25 * (i % 3)] * 64) for i in range(60)]
    monkeypatch.setattr(centroids, "_ROWS", 16)
    assert run(spark, monkeypatch, rows) == sorted(plain(rows), key=repr)
    assert run(spark, monkeypatch, rows, "double") == sorted(plain(rows), key=repr)


def test_few_equal_and_no_vectors(spark, monkeypatch):
    assert run(spark, monkeypatch, []) == [] and run(spark, monkeypatch, [(1, None), (2, [1.0])]) == []
    for rows in ([(1, [0.5] * 64)], [(i, [float(i)] * 64) for i in range(5)], [(i, [1.0] * 64) for i in range(40)], [(7, [0.1] * 64)] * 30 + [(7, [-0.1] * 64)] * 3):
        assert run(spark, monkeypatch, rows) == sorted(plain(rows), key=repr)


def test_partial_distances_lose_no_tie():
    rng = random.Random(2)
    for _ in range(200):
        dims = rng.choice([8, 16, 24, 64])
        x = np.array([[rng.randint(-2, 2) for _ in range(dims)] for _ in range(30)], dtype=np.int64)
        c = np.array([[rng.randint(-2, 2) for _ in range(dims)] for _ in range(rng.randint(1, 8))], dtype=np.int64)
        if rng.random() < 0.5:
            c[-1] = c[0]
        order = np.array(rng.sample(range(dims), dims))
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        best, far = centroids.nearest(x, c, order)
        assert (best == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def test_largest_components(spark):
    """Beyond the clamp, distances stay within 64 bits."""
    df = spark.createDataFrame([(i, [3e38 * (-1) ** i] * 64) for i in range(6)], "vec_id long, embedding array<float>")
    got = centroids.cluster(df, k=1, rounds=0).collect()
    assert {r["distance"] for r in got} == {0, 64 * (2 * centroids._CLAMP) ** 2}
