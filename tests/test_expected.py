"""Expected counts by distance against sums in loops, and by way of a ``.hic`` file."""

import random

import numpy as np
import pytest

from ligaspark import genome
from ligaspark.operators import expected, matrix
from ligaspark.sources import hic
from ligaspark.sources.hic_writer import write_hic

SIZES = [("chr1", 1000), ("chr2", 420), ("chr3", 90), ("chr4", 30)]


@pytest.fixture(scope="module")
def sizes(spark):
    return genome.chromosome_sizes(spark, SIZES)


def _cells():
    rng = random.Random(2)
    starts, at = {}, 0
    for c, n in SIZES:
        starts[c] = (at, -(-n // 10))
        at += -(-n // 10)
    cells = {}
    for _ in range(2000):
        a = rng.randrange(at - 3)  # nothing on the last chromosome
        b = min(at - 4, a + int(rng.expovariate(0.2)))
        cells[a, b] = cells.get((a, b), 0) + 1
    return starts, cells


@pytest.mark.parametrize("enough", [0, 1, 40, 10**9])
def test_against_loops(spark, sizes, enough):
    starts, cells = _cells()
    n = max(k for _, k in starts.values())
    observed, possible, seen = [0] * n, [sum(max(k - d, 0) for _, k in starts.values()) for d in range(n)], {}
    for (a, b), v in cells.items():
        for c, (at, k) in starts.items():
            if at <= a and b < at + k:
                observed[b - a] += v
                seen[c] = seen.get(c, 0) + v
    want = []
    for d in range(n):
        w = 0
        while w < n and sum(observed[max(0, d - w) : d + w + 1]) < enough:
            w += 1
        want.append(sum(observed[max(0, d - w) : d + w + 1]) / sum(possible[max(0, d - w) : d + w + 1]))
    px = spark.createDataFrame([(*k, v) for k, v in cells.items()], "bin1_id long, bin2_id long, count long")
    got = expected.expected(px, sizes, 10, enough)
    assert np.allclose(got.values, want, atol=1e-12)
    for c, (_, k) in starts.items():
        assert got.factors[c] == pytest.approx(sum(want[d] * (k - d) for d in range(k)) / seen[c] if c in seen else 1.0)


def test_without_counts(spark, sizes):
    px = spark.createDataFrame([], "bin1_id long, bin2_id long, count long")
    got = expected.expected(px, sizes, 10)
    assert got.values.tolist() == [0] * 100 and set(got.factors.values()) == {1.0}
    assert expected.over_expected(px, sizes, 10).count() == 0
    assert len(expected.expected(px, sizes.limit(0), 10).values) == 0


def test_by_way_of_a_file(spark, sizes, tmp_path):
    _, cells = _cells()
    px = spark.createDataFrame([(*k, v) for k, v in cells.items()], "bin1_id long, bin2_id long, count long")
    path = str(tmp_path / "m.hic")
    coarse = matrix.coarsen(px, sizes, 10, 30)
    write_hic(spark, {10: px, 30: coarse}, sizes, path)
    source = hic.HadoopFile(spark, path)
    found = hic.read_expected(source, hic.read_header(source).master)
    for r, p in ((10, px), (30, coarse)):
        values, factors = found["NONE", "BP", r]
        want = expected.expected(p, sizes, r)
        assert np.allclose(values, want.values) and np.allclose([factors[k + 1] for k in range(4)], [want.factors[c] for c, _ in SIZES])
    got = {(r["x"] // 10, r["y"] // 10): r["count"] for r in hic.read_hic(spark, path, genome.Region("chr1"), width=10, over_expected=True).collect()}
    want = {(r["bin1_id"], r["bin2_id"]): r["oe"] for r in expected.over_expected(px, sizes, 10).where("bin2_id < 100").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    with pytest.raises(ValueError, match="within a chromosome"):
        hic.read_hic(spark, path, genome.Region("chr1"), genome.Region("chr2"), width=10, over_expected=True)
