"""Profiles and multiple alignment of many sequences."""

import random

import numpy as np
import pytest

from ligaspark.functions import profiles
from ligaspark.functions.alignment import _global
from ligaspark.operators import adapters


def score(a, b):
    return sum(1 if x == y else -1 for x, y in zip(a, b, strict=True))


def test_two_sequences_are_aligned_globally():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 14))) for _ in range(2))
        got = profiles.merged(profiles.of_sequence(a), 1, profiles.of_sequence(b), 1)
        assert (got.sum(axis=1) == 2).all()
        mine = sum(1 if (c[:4] == 2).any() else -1 for c in got)
        assert mine == score(*_global(a, b)), (a, b)
        assert [int(got[:, k].sum()) for k in range(4)] == [(a + b).count(c) for c in "ACGT"]


@pytest.mark.parametrize("together,arity", [(64, 16), (5, 2)])
def test_many_sequences(spark, monkeypatch, together, arity):
    monkeypatch.setattr(adapters, "_TOGETHER_SEQS", together)
    monkeypatch.setattr(adapters, "_ARITY", arity)
    rng = random.Random(2)
    truth = "AGATCGGAAGAGCACACGTCTTGACC"
    rows = []
    for _ in range(900):
        s = list(truth)
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.randrange(len(s))
            s[p : p + 1] = rng.choice([[], [rng.choice("ACGTN")], [s[p], rng.choice("ACGT")]])
        rows.append(("".join(s),))
    df = spark.createDataFrame([*rows, (None,), ("",)], "seq string")
    freq = adapters.aligned_frequency(df)
    got = freq.collect()
    total = {}
    for r in got:
        total[r["pos"]] = total.get(r["pos"], 0) + r["p"]
    assert np.allclose(list(total.values()), 1) and sorted(total) == list(range(len(total)))
    text = adapters.joined(adapters.consensus(freq, 0.75)).first()["consensus"]
    assert text.replace("-", "") == truth
    assert sorted(map(tuple, adapters.aligned_frequency(df.repartition(7)).collect())) == sorted(map(tuple, got))


def test_equal_and_no_sequences(spark):
    one = adapters.aligned_frequency(spark.createDataFrame([("ACN",)] * 5, "seq string")).collect()
    assert sorted(map(tuple, one)) == [(0, "A", 1.0), (1, "C", 1.0)]
    assert adapters.aligned_frequency(spark.createDataFrame([(None,), ("",)], "seq string")).count() == 0
