import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import awkward, frame, tokens
from pyspark.sql import functions as F

from ligaspark.llm import mixing, packing
from ligaspark.llm.common import tokenizer_dir


def plain_best_fit(lengths, capacity):
    rows = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in rows if r[0] >= lengths[i]]
        if fits:
            r = min(fits, key=lambda r: r[0])
            r[0] -= lengths[i]
            r[1].append(i)
        else:
            rows.append([capacity - lengths[i], [i]])
    return rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    got = packing.best_fit_decreasing(np.array(lengths, dtype=np.int64), 50)
    want = plain_best_fit(lengths, 50)
    assert sorted(i for r in got for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= 50 for r in got)
    room = lambda rows: sorted(50 - sum(lengths[i] for i in r) for r in rows)
    assert room(got) == room([r[1] for r in want])


def test_round_trip(spark):
    rows = awkward(11, 60)
    df = frame(spark, rows)
    with open(f"{tokenizer_dir()}/byte_bpe_50k.tiktoken", "rb") as f:
        encode = packing.encoder(f.read())
    for how in ({"seq_len": 64, "rows": 4, "window_tokens": 1000}, {"seq_len": 2048}):
        got = packing.pack(df, **how).collect()
        parts = {}
        for r in got:
            n = r["n_rows"] * r["seq_len"]
            assert len(r["ids"]) == 2 * n and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == n and r["position_resets"] == r["cu_seqlens"][:-1]
            assert len(r["doc_ids"]) == len(r["parts"]) == len(r["cu_seqlens"]) - 1
            position = packing.position_ids(r)
            assert all(position[a] == 0 and position[z - 1] == z - a - 1 for a, z in zip(r["cu_seqlens"], r["cu_seqlens"][1:], strict=False))
            ids = np.frombuffer(r["ids"], np.uint16)
            for a, z, d, p in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["doc_ids"], r["parts"], strict=False):
                assert a // r["seq_len"] == (z - 1) // r["seq_len"]
                if p >= 0:
                    parts.setdefault(d, []).append((p, ids[a:z].tolist()))
        want = {}
        for i, t, *_ in rows:
            full = [*encode(t or "", disallowed_special=()).tolist(), packing.EOS]
            want.setdefault(i, []).extend((k, full[a : a + how["seq_len"]]) for k, a in enumerate(range(0, len(full), how["seq_len"])))
        assert {d: sorted(p) for d, p in parts.items()} == {d: sorted(p) for d, p in want.items()}
    assert packing.pack(frame(spark, [])).count() == 0


def reshared(sizes, share=1.5, weights=(3, 1, 2), most=2):
    """Targets by sharing the excess again and again."""
    w = [weights[i % 3] for i in range(len(sizes))]
    left, out, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while left > 1e-9 and free:
        total = sum(w[i] for i in free)
        give, left = left, 0.0
        for i in list(free):
            out[i] += give * w[i] / total
            if out[i] >= most * sizes[i]:
                left += out[i] - most * sizes[i]
                out[i] = most * sizes[i]
                free.discard(i)
    return out


@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
def test_targets(sizes):
    assert np.allclose(mixing.targets(sizes), reshared(sizes), rtol=1e-9, atol=1e-6)


def mixed(spark, rows, **how):
    return mixing.Mix(frame(spark, rows), **how)


def brute_taken(rows, want, seed="mix"):
    """{(id, size): words} by writing each source's stream out word by word, as often as its target needs."""
    import hashlib

    out = {}
    for s, target in want.items():
        own = sorted((hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:16], r[0] is not None, r[0] or 0, len(tokens(r[1]))) for r in rows if r[3] == s)
        stream = [(k, i) for k, (*_, size) in enumerate(own) for i in range(size)]
        for k, _ in (stream * 2)[: int(target)]:
            key = (own[k][2] if own[k][1] else None, own[k][3])
            out[key] = out.get(key, 0) + 1
    return out


def test_mix(spark):
    rng = random.Random(12)
    rows = awkward(12, 200) + [(5000 + i, "w " * rng.randint(0, 200), "en", rng.choice(["s0", "s0", "s0", "Z", "é", None]), 1) for i in range(300)]
    m = mixed(spark, rows)
    got = m.dealt().collect()
    assert sorted(((r["id"], r["size"], r["source"]) for r in got), key=repr) == sorted(((r[0], len(tokens(r[1])), r[3]) for r in rows), key=repr)
    per, by_text = {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_text[r["id"], r["size"]] = by_text.get((r["id"], r["size"]), 0) + r["taken"]
        p = per.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        p[0] += r["size"]
        p[1] += r["taken"]
    names = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + [None]
    want = reshared([per[s][0] for s in names])
    for s, t in zip(names, want, strict=True):
        size, taken, target, source_size = per[s]
        assert source_size == size and abs(target - t) < 1e-6 and 0 <= target - taken < 1, (s, per[s])
    assert {k: v for k, v in by_text.items() if v} == brute_taken(rows, {s: per[s][2] + 1e-9 for s in names})
    again = mixed(spark, list(reversed(rows)))
    assert sorted(((r["id"], r["size"], r["taken"]) for r in again.dealt().collect()), key=repr) == sorted(((r["id"], r["size"], r["taken"]) for r in got), key=repr)


@pytest.mark.parametrize("words", [20, 100])
def test_small_sources_meet_their_targets(spark, words):
    """Sources smaller than a block: every one within a word of its target."""
    rows = [(i, "w " * words, "en", f"s{i:04}", 1) for i in range(1000)]
    got = mixed(spark, rows).dealt().collect()
    assert len(got) == 1000 and all(0 <= r["target"] - r["taken"] < 1 for r in got)
    assert abs(sum(r["taken"] for r in got) - 1.5 * 1000 * words) <= 1000


def test_schedule(spark):
    rows = [(i, "w " * 50, "en", f"s{i % 3}", 1) for i in range(300)]
    m = mixed(spark, rows, block_tokens=16)
    slots = sorted(tuple(r) for r in m.schedule().collect())
    assert len({s[0] for s in slots}) == len(slots)
    for s in range(3):
        own = [x for x in slots if x[1] == s]
        assert sorted(x[2] for x in own) == list(range(-(-m.words[s] // 16))) and sum(x[3] for x in own) == m.words[s]
        first = [x for x in own if x[0] < m.n_slots // 4]
        assert abs(len(first) - len(own) / 4) < 5  # each stretch of the mix has its share
    parts = m.mixed_blocks().groupBy("s", "rank").agg(F.sum("n").alias("n"), F.max("words").alias("w")).collect()
    assert all(p["n"] == p["w"] for p in parts)  # a slot yields the words that it counts for
    words = {r["id"]: r["n"] for r in m.mixed_blocks().groupBy("id").agg(F.sum("n").alias("n")).collect()}
    assert words == {r["id"]: r["taken"] for r in m.dealt().collect() if r["taken"]}


def test_copies(spark):
    rows = awkward(13, 90)
    df = frame(spark, rows)
    out = mixing.repeat_documents(df)
    assert out.columns == df.columns
    n, per = {}, {}
    for r in out.collect():
        n[r["doc_id"], r["text"]] = n.get((r["doc_id"], r["text"]), 0) + 1
        per[r["source"]] = per.get(r["source"], 0) + len(tokens(r["text"]))
    for (i, t), k in n.items():
        assert k <= 2 * sum(r[:2] == (i, t) for r in rows) and tokens(t)
    targets = {r["source"]: r["target"] for r in mixed(spark, rows).docs.collect()}
    longest = {s: max(len(tokens(r[1])) for r in rows if r[3] == s) for s in targets}
    assert all(abs(per.get(s, 0) - t) <= longest[s] + 1 for s, t in targets.items())


def test_very_long_text_is_mixed(spark):
    rows = [(1, "wort " * 400_000, "en", "a", 1), (2, "x y z", "en", "b", 1)]
    got = {r["id"]: r for r in mixed(spark, rows).dealt().collect()}
    assert got[1]["size"] == 400_000 and all(0 <= r["target"] - r["taken"] < 1 for r in got.values())


def test_mix_of_nothing(spark):
    assert mixed(spark, []).docs.count() == 0 and mixing.repeat_documents(frame(spark, [])).count() == 0
    empty = [(1, "", "en", "a", 0), (2, None, "en", None, 0)]
    assert [r["taken"] for r in mixed(spark, empty).dealt().collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixed(spark, [(1, "a", "en", "a", 0), (2, "b", "en", "b", 0)], max_sources=1)
