import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_data import awkward, frame, prose, words
from pyspark.sql import functions as F

from ligaspark.llm import boosting, bytesops, features, language, quality, queries, topk, toxicity
from ligaspark.llm.common import bounded_sample, remainder

SF = "/root/testdata/sf0.01"


def cut(text, sample):
    """Phrases of a greedy parse, by substring search."""
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_phrases_are_the_greedy_parse():
    """Of whole texts, whatever the stretches: random ones, periodic ones whose stretches never agree, pieces of the sample, and a long one."""
    rng = random.Random(2)
    samples = {"a": ["".join(rng.choice("abc ") for _ in range(200))], "b": ["".join(rng.choice("bcd ") for _ in range(200))], "c": ["aab" * 5 + "aaa" + "ab" * 40]}
    squeeze = lambda s: "".join(c for i, c in enumerate(s) if c != " " or s[i - 1 : i] != " ")
    texts = ["".join(rng.choice("abcdx  ") for _ in range(rng.randint(0, 70))) for _ in range(40)]
    texts += ["a" * 500, "ab" * 300, "aab" * 200, "abcd" * 100, "", "x" * 100, samples["a"][0] * 4, samples["c"][0][3:] + samples["b"][0], "".join(rng.choice("ab") for _ in range(3000))]
    for stretch in (3, 16, 256):
        m = language.build(samples, stretch=stretch)
        got, n = m.phrases(pa.array(texts))
        for t, g, k in zip(texts, got.T, n, strict=True):
            own = squeeze(t)
            assert k == len(own)
            for lang, have in zip(m.languages, g, strict=True):
                assert have == cut(own, squeeze(samples[lang][0])), (t, lang, stretch)


def test_a_very_long_periodic_text_is_parsed():
    m = language.build({"a": ["aaa b"], "b": ["abab ab"]})
    got, n = m.phrases(pa.array(["a" * 2_000_000, "ab" * 20]))
    assert got[:, 0].tolist() == [-(-2_000_000 // 3), 2_000_000] and n.tolist() == [2_000_000, 40]


def test_many_languages_come_in_blocks(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02}": prose(rng, 200, ["".join(rng.choice(letters) for _ in range(3)) for _ in range(6)]) for k in range(30)}
    df = frame(spark, [(100 * k + j, own[x], x, "s", 1) for k, x in enumerate(own) for j in range(3)])
    many, one = language.fit(df, languages_per_block=7), language.fit(df, languages_per_block=64)
    assert len(many) == 5 and len(one) == 1
    a, b = ({r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in language.identify(df, m).collect()} for m in (many, one))
    assert {i: x[0] for i, x in a.items()} == {i: x[0] for i, x in b.items()} == {100 * k + j: x for k, x in enumerate(own) for j in range(3)}


def test_language_accuracy(spark):
    found = queries.op8_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    for r in rows[:50]:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 and 0 <= r["score"] <= 1


def test_language_of_odd_rows(spark):
    rng = random.Random(3)
    rows = awkward(8, 40) + [(3000 + i, prose(rng, 60, ["der", "die", "und", "ung", "sch", "ü"]), "de", "s", 1) for i in range(20)] + [(4000 + i, prose(rng, 60, ["the", "of", "ing", "tion", "w"]), "en", "s", 1) for i in range(20)]
    df = frame(spark, rows)
    m = language.fit(df)
    got = language.identify(df, m).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by[100] == by[101] == by[102] == by[105] == [("und", 0.0)] and by[104][0][0] != "und" and by[3000][0][0] == "de" and by[4001][0][0] == "en"
    kept = language.keep_languages(df, m)
    assert kept.columns == df.columns and kept.count() == sum(r["lang_pred"] != "und" for r in got)
    none = language.fit(df.where("lang is null"))
    assert {r["lang_pred"] for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(frame(spark, []), m).count() == 0


def test_samples_are_bounded_and_stable(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("string").alias("g"))
    a = bounded_sample(df, 40, group="g")
    assert a == bounded_sample(df.repartition(7), 40, group="g") and len(a) <= 80 and {g for g, _ in a} == {"true", "false"}
    assert bounded_sample(df.limit(0), 40) == []


def test_toxicity(spark):
    found = queries.op3_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.75 and sum(r["predicted"] for r in clean) / len(clean) < 0.01
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(4)
    rows = awkward(9, 80) + [(3000 + i, prose(rng, 30) + " villain", "en", "s", 1) for i in range(40)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(3000 + i, 1) for i in range(40)] + [(i, 0) for i in range(80)] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    s = toxicity.fit(df, labels)
    got = toxicity.score(df, s).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] >= 0.5 for r in got if r["doc_id"] and r["doc_id"] >= 3000) and all(r["score"] < 0.5 for r in got if r["doc_id"] is None or r["doc_id"] < 3000)
    nothing = toxicity.fit(df, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score(df, nothing).collect()} == {0.0}
    assert toxicity.score(frame(spark, []), s).count() == 0


def brute_words(rows, ids_p, ids_u, least, min_z):
    """{word: z} of the words that count as features, by plain sets."""
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets.setdefault(i, set()).update(words(t))
    pos, unl = [sets[i] for i in ids_p if i in sets], [sets[i] for i in ids_u if i in sets]
    out = {}
    for w in set().union(*pos):
        p, u = sum(w in s for s in pos), sum(w in s for s in unl)
        rest = (p + u) / (len(pos) + len(unl))
        z = (p / len(pos) - u / len(unl)) / (max(rest * (1 - rest), 1e-9) * (1 / len(pos) + 1 / len(unl))) ** 0.5
        if p >= least and z > min_z:
            out[w] = z
    return out


def test_toxicity_is_brute_force(spark):
    """The words chosen, and the score of every text, from plain sets of words and the scorer's weights."""
    rng = random.Random(14)
    rows = awkward(15, 120) + [(3000 + i, prose(rng, 30) + f" villain rogue{i % 3} {'scoundrel' if i % 2 else ''}", "en", "s", 1) for i in range(60)] + [(3001, "other text of one id", "en", "s", 1)]
    df = frame(spark, rows).repartition(3)
    labels = [(3000 + i, 1) for i in range(60)] + [(i, 0) for i in range(120)]
    s = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), least=3, min_z=2.0)
    kept = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    want = brute_words(rows, [i for i, y in labels if y and kept(i)], sorted({r[0] for r in rows if r[0] is not None and kept(r[0])}), 3, 2.0)
    hashed = {w: int(bytesops.Words(pa.array([w])).hashes()[0]) for w in want}
    assert sorted(hashed.values()) == s.keys.tolist() and {"villain", "scoundrel"} <= set(want)
    weight = {w: s.weights[s.keys.tolist().index(h)] for w, h in hashed.items()}
    for r in toxicity.score(df, s).collect():
        texts = [t for i, t, *_ in rows if i == r["doc_id"]]
        near = [1 / (1 + np.exp(-np.clip(s.bias + sum(weight[w] for w in set(words(t)) & set(weight)), -30, 30))) for t in texts]
        assert any(abs(r["score"] - x) < 1e-9 for x in near)


def test_pu_steps_go_down_the_risk():
    """Training ends near the least risk that small steps around it can find, and the risk itself is the estimator's, written out row by row."""
    rng = np.random.default_rng(7)
    y = rng.random(1500) < 0.3
    x = np.where(y[:, None], rng.random((1500, 3)) < 0.6, rng.random((1500, 3)) < 0.2).astype(np.float64)
    xp, prior = x[y][:150], 0.3
    w, b = toxicity.non_negative_pu(xp.astype(np.float32), x.astype(np.float32), prior, steps=2000)
    def slow(w, b):
        loss = lambda r, s: np.log1p(np.exp(-s * (sum(p * q for p, q in zip(r, w, strict=True)) + b)))
        pos = sum(loss(r, 1) for r in xp) / len(xp)
        neg = sum(loss(r, -1) for r in x) / len(x) - prior * sum(loss(r, -1) for r in xp) / len(xp)
        return prior * pos + max(0.0, neg)

    here = toxicity.risk(xp, x, prior, w, b)
    assert abs(here - slow(w, b)) < 1e-9
    for j in range(4):
        for d in (-0.05, 0.05):
            step = np.eye(4)[j] * d
            assert toxicity.risk(xp, x, prior, w + step[:3], b + step[3]) > here - 1e-4
    assert here < toxicity.risk(xp, x, prior, np.zeros(3), 0.0)


def test_pu_risk_needs_no_negatives():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    x = np.where(y[:, None], rng.random((4000, 6)) < 0.7, rng.random((4000, 6)) < 0.15).astype(np.float32)
    w, b = toxicity.non_negative_pu(x[y][:200], x, 0.2)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert ((p > 0.5) == y).mean() > 0.9


def test_quality(spark):
    found = queries.op4_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_quality_of_odd_rows(spark):
    df = frame(spark, awkward(10, 60))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (7, None)], "doc_id long, quality int")
    got = quality.score(df, quality.fit(df, labels)).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    none = quality.score(df, quality.fit(df, labels.limit(0))).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.score(frame(spark, []), quality.fit(df, labels)).count() == 0


def test_statistics_of_texts():
    t = features.table(pa.array(["Ab ab AB!\nab", None, "", "ÉÉ 12 zz??"]))
    col = {n: t[:, i] for i, n in enumerate(features.NAMES)}
    assert np.allclose(np.expm1(col["log_words"]), [4, 0, 0, 3]) and np.allclose(col["distinct_words"], [0.25, 0, 0, 1]) and np.allclose(col["common_word_share"], [1, 0, 0, 1 / 3])
    assert np.allclose(np.expm1(col["lines_log"]), [2, 0, 0, 1]) and col["longest_word"].tolist() == [2, 0, 0, 4] and np.isfinite(t).all()
    alone = np.concatenate([features.table(pa.array([x])) for x in ["Ab ab AB!\nab", None, "", "ÉÉ 12 zz??"]])
    assert np.allclose(t, alone)


def brute_statistics(t):
    """All statistics of one text, from plain words, lines and characters."""
    t = t or ""
    raw = t.encode()
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    ws = [m for m in re.finditer("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)]
    size = [len(m[0].encode()) for m in ws]
    lines = [x for x in low.split("\n") if x]
    mean = sum(size) / max(1, len(ws))
    punct = [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ",."]
    share = lambda f: sum(f(c) for c in raw) / max(1, len(raw))
    most = lambda xs: max((xs.count(x) for x in set(xs)), default=0)
    own, n, k = [m[0] for m in ws], max(1, len(ws)), max(1, len(lines))
    return [
        np.log1p(len(raw)), np.log1p(len(ws)), mean, max(0.0, sum(s * s for s in size) / n - mean * mean) ** 0.5, max(size, default=0),
        sum(65 <= c <= 90 for c in raw) / max(1, sum(c >= 97 for c in low.encode())), share(lambda c: 48 <= c <= 57), share(lambda c: 9 <= c <= 13 or c == 32), share(lambda c: c == 10),
        share(lambda c: c in b",."), share(lambda c: c in punct), share(lambda c: c >= 128), share(lambda c: c == 124), share(lambda c: c in b"#$%&*"), share(lambda c: c == 33),
        sum(a == b and a in punct for a, b in zip(raw, raw[1:], strict=False)) / max(1, len(raw)), len(set(own)) / n, most(own) / n, sum(s <= 3 for s in size) / n,
        np.log1p(len(lines)), len(ws) / k, len(set(lines)) / k, sum("A" <= t[m.start()] <= "Z" for m in ws) / n, most(lines) / k,
        sum(m.end() < len(t) and ord(t[m.end()]) in punct for m in ws) / n,
    ]


def test_statistics_are_brute_force():
    rng = random.Random(6)
    texts = [r[1] for r in awkward(3, 12)] + ["A|b ## !! ;; x-y, z.\n\nA|b\n" * 9, "".join(rng.choice("ab AB\n,.;!#|é0 ") for _ in range(3000)), "x" * 1_200_000 + " y"]
    got = features.table(pa.array(texts))
    for t, row in zip(texts, got, strict=True):
        assert np.allclose(row, brute_statistics(t), rtol=2e-5, atol=1e-6), [(n, a, b) for n, a, b in zip(features.NAMES, row, brute_statistics(t), strict=True) if not np.isclose(a, b, rtol=2e-5, atol=1e-6)]


def brute_first_split(x, y, bins, ridge, least):
    """The best first split of the first tree, over all thresholds between bins of every feature."""
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + ridge)
    best = (1e-6, None, None)
    for j in range(x.shape[1]):
        for c in np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)):
            left = x[:, j] <= c
            if min(left.sum(), (~left).sum()) >= least:
                value = gain(left) + gain(~left) - gain(np.ones(len(y), bool))
                if value > best[0] + 1e-12:
                    best = (value, j, c)
    return best


def test_trees_are_grown_right():
    """Splits and leaf values of the first tree, by trying all of them; the loss falls with every tree."""
    rng = np.random.default_rng(5)
    x = rng.random((600, 4)).astype(np.float32)
    y = (x[:, 2] + 0.3 * rng.random(600) > 0.7).astype(float)
    f = boosting.train(x, y, trees=30, depth=2, bins=16, rate=0.2)
    _, j, c = brute_first_split(x, y, 16, 2.0, 5.0)
    assert f.feature[0][0] == j and f.threshold[0][0] == c
    for side, node in ((x[:, j] <= c, 1), (x[:, j] > c, 2)):
        p = y.mean()
        xs, ys = x[side], y[side]
        g, h = p - ys, np.full(len(ys), p * (1 - p))
        k, t = f.feature[0][node], f.threshold[0][node]
        for m, leaf in ((xs[:, k] <= t, 2 * (node - 1)), (xs[:, k] > t, 2 * (node - 1) + 1)):
            assert np.isclose(f.value[0][leaf], -0.2 * g[m].sum() / (h[m].sum() + 2.0) if m.any() else 0.0, atol=1e-5)
    loss = lambda n: -np.mean(np.log(np.clip(np.where(y > 0, *(lambda s: (s, 1 - s))(boosting.Forest(f.base, f.depth, f.feature[:n], f.threshold[:n], f.value[:n]).score(x))), 1e-12, 1)))
    assert all(loss(n + 5) < loss(n) for n in range(0, 25, 5))


def test_trees_are_walked_right():
    rng = np.random.default_rng(0)
    x = rng.random((800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    f = boosting.train(x, y, trees=25, depth=3)
    assert ((f.score(x) > 0.5) == y).mean() > 0.95

    def walk(row):
        total = f.base
        for feat, thr, val in zip(f.feature, f.threshold, f.value, strict=True):
            node = 0
            for _ in range(f.depth):
                node = 2 * node + (2 if row[feat[node]] > thr[node] else 1)
            total += val[node - len(thr)]
        return total

    assert np.allclose(f.margin(x[:50]), [walk(r) for r in x[:50]])
    assert np.allclose(boosting.train(x, np.ones(800)).score(x), 0.99) and len(boosting.train(x[:0], y[:0]).score(x)) == 800


def brute_top(rows, k, is_query):
    ok = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    first = {}
    for i, v in sorted(ok, key=lambda r: (r[0], len(r[1]), r[1])):
        if is_query(i):
            first.setdefault(i, v)
    for q, v in first.items():
        best = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for i, x in ok if i != q and len(x) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_top_k_is_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # a common vector: ties
    rows += [(300, None), (301, [0.1, None, 0.2, 0.1, 0.1, 0.3]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (None, [0.1] * 6), (310, [0.5, 0.5]), (320, [0.25, 0.5]), (330, []), (5, rows[9][1]), (10, rows[11][1])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    rows += [(400 + i, [c * 4 + 1 for c in rows[i][1]]) for i in range(25)]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    got = topk.top_k(df, lambda i: i % 10 == 0, block=block, pivots=8, queries_per_salt=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5, lambda i: i % 10 == 0)


def test_pivots_save_work():
    rng = np.random.default_rng(3)
    centers = rng.integers(-200, 200, (20, 8))
    x = (centers[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, (3000, 8))).astype(float)
    pivots = topk.choose_pivots(x[:256], 16)
    far, n2 = topk.to_pivots(x, pivots), (x * x).sum(axis=1)
    block = topk.Candidates(np.arange(3000), x, n2, far)
    for i, (rows, got) in enumerate(block.best(list(range(20)), x[:20], n2[:20], far[:20], 5, [None] * 20)):
        want = sorted((-float(x[i] @ x[j]), j) for j in range(3000) if j != i)[:5]
        assert [(-s, r) for r, s in zip(rows.tolist(), got, strict=True)] == want
    assert block.work < 0.5 * 20 * 3000


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i, -3e6, 4e6 - i * i]) for i in range(60)] + [(100, [1e300, -1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = lambda v: [max(-(2**31 - 1), min(2**31 - 1, int(np.floor(256 * max(-1e9, min(1e9, c)))))) for c in v]
    want = sorted((-sum(a * b for a, b in zip(q(rows[50][1]), q(v), strict=True)), i) for i, v in rows if i != 50)[:5]
    got = [(-r["score"], r["id"]) for r in topk.top_k(df, lambda i: i == 50).orderBy("rank").collect()]
    assert got == [(max(-(2**63 - 1), s), i) for s, i in want]


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i % 50 == 0).count() == 0


def test_folds(spark):
    row = spark.createDataFrame([(17,), (None,)], "doc_id long").select(remainder(F.col("doc_id"), 5)).collect()
    assert [r[0] for r in row] == [zlib.crc32(b"17") % 5, None]
