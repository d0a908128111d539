"""Suffix arrays against sorting, searches and shared substrings against scans."""

import random

import pytest

from ligaspark.operators import adapters, suffix_array


def _texts():
    rng = random.Random(8)
    some = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(6)]
    copied = "".join(rng.choice("ACGT") for _ in range(150))
    return {str(i): t for i, t in enumerate([*some, some[3], copied, "x" + copied + "é", copied[40:], "a" * 70, "ab" * 300, "", None, "\nq\n"])}


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def table(spark, texts):
    return spark.createDataFrame(list(texts.items()), "name string, seq string")


@pytest.fixture(scope="module")
def found(table):
    return suffix_array.ranks(table)


def test_order_and_lcp(found, texts):
    got = [(r["name"], r["pos"], r["lcp"]) for r in suffix_array.suffix_array(found).orderBy("ord").collect()]
    want = sorted((t[i:].encode(), n, i) for n, t in texts.items() if t for i in range(len(t)))
    assert [(n, i) for n, i, _ in got] == [(n, i) for _, n, i in want]

    def lcp(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    cut = [texts[n][i:] for _, n, i in want]
    assert [x for _, _, x in got] == [0, *[lcp(a, b) for a, b in zip(cut, cut[1:], strict=False)]]


def test_ranks_are_those_of_suffixes(found, texts):
    every = sorted(t[i:].encode() for t in texts.values() if t for i in range(len(t)))
    first = {}
    for k, s in enumerate(every):
        first.setdefault(s, k)
    assert all(r["rank"] == first[texts[r["name"]][r["pos"] :].encode()] for r in found.suffixes.collect())


def test_occurrences(spark, table, texts):
    copied = texts["7"]
    patterns = ["a", "ab", "bab", "aaaa", "ab" * 8, "ab" * 9, "c", "b" * 50, "", None, "é", "\n", copied, copied[3:130], copied[:17], copied[20:52], copied[20:51] + "A", "a" * 70, "a" * 71, "a" * 32, "ab" * 300, "ba" * 150, "ab"]
    got = suffix_array.occurrences(table, spark.createDataFrame(list(enumerate(patterns)), "pattern_id long, pattern string"))
    want = sorted((str(k), n, i) for k, p in enumerate(patterns) if p for n, t in texts.items() if t for i in range(len(t)) if t.startswith(p, i))
    assert sorted(map(tuple, got.collect())) == want
    assert suffix_array.occurrences(table, spark.createDataFrame([], "pattern_id long, pattern string")).count() == 0
    assert suffix_array.occurrences(table.limit(0), spark.createDataFrame([(1, "a")], "pattern_id long, pattern string")).count() == 0


def test_longest_shared(spark, found, texts):
    held = [t for t in texts.values() if t]
    for least in (2, 3, 4, 8, len(held), len(held) + 1):
        subs = {}
        for k, t in enumerate(held):
            for s in {t[i:j] for i in range(len(t)) for j in range(i + 1, min(len(t), i + 160) + 1)}:
                subs.setdefault(s, set()).add(k)
        common = [s for s, k in subs.items() if len(k) >= least]
        n = max(map(len, common), default=0)
        length, places = suffix_array.longest_shared(found, least)
        assert length == n and suffix_array.longest_common(found, least) == min((s for s in common if len(s) == n), default="", key=str.encode)
        best = {s for s in common if len(s) == n}
        assert sorted((r["name"], r["pos"]) for r in places.collect()) == sorted((m, i) for m, t in texts.items() if t for i in range(len(t)) if n and t[i : i + n] in best)


def test_longest_common_of_all(spark):
    rows = lambda *t: spark.createDataFrame([(x,) for x in t], "seq string")
    core = "ACGGT" * 9
    assert adapters.longest_common_substring(rows("TT" + core + "A", core, "G" + core + "TTT")) == core
    assert adapters.longest_common_substring(rows("xay", "ybx")) == "x"
    assert adapters.longest_common_substring(rows("xay", None)) == "" == adapters.longest_common_substring(rows("xay", ""))


def test_windows_of_long_texts(spark):
    text = "".join(random.Random(3).choice("ACGT") for _ in range(5000))
    got = suffix_array.windows(spark.createDataFrame([("a", text)], "name string, seq string")).collect()
    assert sorted((r["pos"], r["left"], r["word"]) for r in got) == [(i, 5000 - i, text[i : i + 16]) for i in range(5000)]
