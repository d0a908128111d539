"""Centroid clustering of integer vectors with partial-distance search.

Vectors of exactly ``dims`` components, none null or not finite, are kept, and each component x becomes floor(``scale`` * x). Centroids start as the ``k`` kept
vectors whose ids hash smallest. Each round assigns every vector to the nearest centroid (squared distance in integers; ties to the smaller number) and replaces
every centroid that has vectors by their componentwise floor(sum / count); after the last round vectors are assigned once more.

Assignment is a partial-distance search: dimensions are taken by falling variance over the table, ``GROUP`` at a time. The centroid nearest in the first group is
measured whole; every other one goes on only while its partial sum is not above the best distance so far, and is dropped once strictly above, so ties are never
lost; what is left after all dimensions is compared exactly.

The kept vectors are written once, as binary integers. A round is one pass over them: each task adds up its own vectors per centroid and gives out ``k`` rows,
so nothing is shuffled but sums and no cluster's size matters. The driver holds ``k`` centroids and their sums, and sends only those. A pass lost with its executor is
made anew from the table.

Null vectors take no part; a null id is hashed as the empty text, and rows that share an id start in order of their components. Components are clamped to
2**26 after scaling, so squared distances fit into 64 bits; sums are exact integers at every size. With fewer than ``k`` kept vectors there are as many centroids.
Only the two columns named are read, so no other can clash. Without kept vectors the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialize

K, DIMS, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, "3"
GROUP = 8
_CLAMP, _RAISED = 1 << 26, 1 << 31
_ROWS = 16_384  # of a NumPy pass


def integers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v binary): the kept vectors, ``dims`` integers of 32 bits each, big-endian and raised by 2**31, so their bytes sort as the components do."""
    inner = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            whole = np.flatnonzero(pc.equal(pc.list_value_length(v), dims).fill_null(False).to_numpy(zero_copy_only=False))
            for a in range(0, len(whole), _ROWS):
                some = batch.take(pa.array(whole[a : a + _ROWS]))
                x = some.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)  # nulls become NaN
                good = np.isfinite(x).all(axis=1)
                x = np.clip(np.floor(x[good] * scale), -_CLAMP, _CLAMP).astype(np.int64) + _RAISED
                yield pa.RecordBatch.from_arrays([some.column(0).filter(pa.array(good)), pa.array([r.tobytes() for r in x.astype(">u4")], pa.binary())], names=["id", "v"])

    return inner.mapInArrow(run, T.StructType([T.StructField("id", inner.schema["id"].dataType), T.StructField("v", T.BinaryType())]))


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, dims), dtype=np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, dims).astype(np.int64) - _RAISED


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row; ``order`` lists the dimensions, most telling first."""
    x, c = x[:, order], centroids[:, order]
    groups = [slice(a, a + GROUP) for a in range(0, x.shape[1], GROUP)]
    part = lambda rows, k, g: ((rows[:, g] - c[k, g]) ** 2).sum(axis=1)
    first = np.stack([part(x, k, groups[0]) for k in range(len(c))], axis=1)
    best = first.argmin(axis=1)
    far = ((x - c[best]) ** 2).sum(axis=1)
    begun = best.copy()
    for k in range(len(c)):
        left = np.flatnonzero((begun != k) & (first[:, k] <= far))
        sums = first[left, k]
        for g in groups[1:]:
            sums = sums + part(x[left], k, g)
            on = sums <= far[left]
            left, sums = left[on], sums[on]
        won = (sums < far[left]) | (k < best[left])
        best[left[won]], far[left[won]] = k, sums[won]
    return best, far


def _sums(table: DataFrame, centroids: np.ndarray, order: np.ndarray) -> tuple[dict[int, list[int]], dict[int, int], dict[int, int]]:
    """Per cluster: the sums of its vectors' components, their number, and the sum of their distances."""
    k, dims = centroids.shape

    def run(batches):
        total, count, inertia = [[0] * dims for _ in range(k)], [0] * k, [0] * k
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                x = unpacked(batch.column(1).slice(a, _ROWS), dims)
                best, far = nearest(x, centroids, order)
                for c in np.unique(best).tolist():
                    own = best == c
                    total[c] = [t + s for t, s in zip(total[c], x[own].sum(axis=0).tolist(), strict=True)]
                    count[c] += int(own.sum())
                    inertia[c] += sum(far[own].tolist())
        some = [c for c in range(k) if count[c]]
        text = lambda values: pa.array([str(v) for v in values], pa.string())
        at = [(c, d) for c in some for d in range(-2, dims)]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in at], pa.int32()), pa.array([d for _, d in at], pa.int32()), text([count[c] if d == -2 else inertia[c] if d == -1 else total[c][d] for c, d in at])], names=["c", "d", "s"])

    made = table.mapInArrow(run, "c int, d int, s string").groupBy("c", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    got = {(r["c"], r["d"]): int(r["s"]) for r in made}
    some = sorted({c for c, _ in got})
    return {c: [got[c, d] for d in range(dims)] for c in some}, {c: got[c, -2] for c in some}, {c: got[c, -1] for c in some}


def by_variance(table: DataFrame, dims: int) -> np.ndarray:
    """Dimensions by falling variance over all vectors."""

    def run(batches):
        n, s, q = 0, np.zeros(dims), np.zeros(dims)
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                x = unpacked(batch.column(1).slice(a, _ROWS), dims).astype(float)
                n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, n), pa.int64()), pa.array(s), pa.array(q)], names=["d", "n", "s", "q"])

    rows = table.mapInArrow(run, "d int, n long, s double, q double").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
    var = {r["d"]: r["q"] / r["n"] - (r["s"] / r["n"]) ** 2 if r["n"] else 0.0 for r in rows}
    return np.array(sorted(range(dims), key=lambda d: (-var.get(d, 0.0), d)))


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>), a row per kept vector."""
    table = materialize(integers(vectors, dims, scale, id_col, vector))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = pa.array([bytes(r["v"]) for r in table.select(hashed.alias("h"), "v").orderBy("h", "v").limit(k).collect()], pa.binary())
    few = unpacked(first, dims)
    spark = vectors.sparkSession
    own = table.schema["id"].dataType
    out = T.StructType([T.StructField(id_col, own), *T.StructType.fromDDL("cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>").fields])
    if not len(few):
        discard(table)
        return spark.createDataFrame([], out)
    centroids, order = few, by_variance(table, dims)
    for _ in range(rounds):
        total, count, _ = _sums(table, centroids, order)
        centroids = np.array([[s // count[c] for s in total[c]] if c in count else old.tolist() for c, old in enumerate(centroids)], dtype=np.int64)
    _, _, inertia = _sums(table, centroids, order)
    every = sum(inertia.values())

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                some = batch.slice(a, _ROWS)
                best, far = nearest(unpacked(some.column(1), dims), centroids, order)
                arrays = [some.column(0), pa.array(best, pa.int32()), pa.array(far, pa.int64()), pa.array([inertia[c] for c in best.tolist()], pa.int64()), pa.array([every] * len(best), pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([centroids[c].tolist() for c in best.tolist()], pa.list_(pa.int32()))], names=out.names)

    return table.mapInArrow(run, out)
