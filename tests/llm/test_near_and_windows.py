import hashlib
import random

import numpy as np
import xxhash
from llm_data import awkward, frame, prose, words

from ligaspark.llm import bytesops, decontaminate, simhash


def brute_print(text):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in __import__("re").findall("[^\x20\x09-\x0d]+", text or "")]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    """[(id, fingerprint, component)] by comparing all pairs of texts."""
    prints = [(i, brute_print(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f, least[find(k)]) for k, (i, f) in enumerate(prints)]


def near_rows(seed):
    """Chains and groups of texts that differ in a few of many words, besides the awkward ones."""
    rng = random.Random(seed)
    rows = awkward(seed, 12)
    for g in range(4):
        base = prose(rng, 400).split()
        for k in range(6):
            i = rng.randrange(len(base))
            base[i] = base[i] + "x"
            rows.append((1000 + 10 * g + k if g else 2000 - k, " ".join(base), "en", "s", 1))
    return rows


def test_simhash_is_brute_force(spark):
    rows = near_rows(3)
    got = simhash.near_duplicates(frame(spark, rows).repartition(5))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1)
    have = sorted(((r["doc_id"], r["fp"] % 2**64, r["component"]) for r in got.collect()), key=key)
    want = sorted(brute_components([(r[0], r[1]) for r in rows]), key=key)
    assert have == want
    assert sum(1 for i, _, c in want if i is not None and i != c) > 5


def test_fingerprints_of_long_texts(monkeypatch):
    """Stretches do not show: whatever they are, the fingerprint is that of all shingles."""
    rng = random.Random(6)
    texts = ["", "  ", "a", "a b", "a b c", " a\tb ", prose(rng, 300), "x" * 500 + " y", "\n".join(prose(rng, 3) for _ in range(40)), "Ünï " * 50]
    for size in (1, 7, 64, 262_144):
        monkeypatch.setattr(simhash, "_STRETCH", size)
        assert [simhash.fingerprint(t.encode()) % 2**64 for t in texts] == [brute_print(t) for t in texts]
    monkeypatch.setattr(simhash, "_STRETCH", 262_144)
    long = prose(rng, 250_000)
    monkeypatch.undo()
    a = simhash.fingerprint(long.encode())
    monkeypatch.setattr(simhash, "_STRETCH", 10**9)
    assert a == simhash.fingerprint(long.encode())


def test_ball_links_are_complete(spark):
    rng = random.Random(9)
    prints = {rng.getrandbits(64)}
    while len(prints) < 300:
        p = rng.choice(sorted(prints)) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(1, 3)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(r) for r in simhash.ball_links(df).collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in links)
    comp = {r["node"]: r["root"] for r in simhash.components(simhash.ball_links(df)).collect()}
    parent = {p: p for p in signed}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) % 2**64).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {p: find(p) for p in signed if p in comp} == comp and all(p in comp or find(p) == p for p in signed)


def test_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)], "u long, v long")
    assert {r["root"] for r in simhash.components(links).collect()} == {0}


def test_one_of_each_group_stays(spark):
    rows = near_rows(4)
    kept = simhash.keep_first(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    groups = {}
    for i, f, c in brute_components([(r[0], r[1]) for r in rows]):
        groups.setdefault(c, set()).add((i, f))
    got = [(r["doc_id"], brute_print(r["text"])) for r in kept.collect()]
    want = [(c, f) for c, g in groups.items() for i, f in g if i == c]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(set(got)) == len(got)


def test_simhash_of_nothing(spark):
    empty = frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def brute_hits(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(width, len(v))
        for a in range(len(v) - n + 1) if n else []:
            for b in range(len(w) - n + 1):
                if w[b : b + n] == v[a : a + n]:
                    hit.update(range(b, b + n))
                    found.add(str(item))
    ids = sorted(found)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def window_case(spark):
    rng = random.Random(8)
    items = [(k, prose(rng, n)) for k, n in ((1, 25), (2, 10), (3, 4), (10, 60), (11, 12))] + [(20, None), (21, ""), (22, "... !"), (1, "again item one"), (30, "Straße und mehr")]
    rows = awkward(5, 15)
    for k in range(20):
        t = prose(rng, 40).split()
        src = (rng.choice(items)[1] or "x").split()
        at, n = rng.randrange(len(src)), rng.randint(1, 30)
        t[rng.randrange(40) : 0] = [w.upper() + rng.choice([",", ";  ", "\n"]) if rng.random() < 0.2 else w for w in src[at : at + n]]
        rows.append((500 + k, "-".join(t) if k % 5 == 0 else " ".join(t), "en", "s", 1))
    rows.append((600, "straße UND mehr; STRASSE und mehr, Straße und Mehr", "de", "s", 1))
    return rows, items, spark.createDataFrame(items, "item_id long, text string")


def test_windows_are_brute_force(spark):
    rows, items, bench = window_case(spark)
    for how in ({}, {"block_bytes": 150}):  # one block of items, and several
        got = decontaminate.report(frame(spark, rows), bench, **how)
        have = sorted((tuple(r) for r in got.collect()), key=repr)
        assert have == sorted(((r[0], *brute_hits(r[1], items)) for r in rows), key=repr)


def test_equal_hashes_are_told_apart_by_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(decontaminate, "window_hashes", lambda h, w: bytesops.window_hashes(h, w) % np.uint64(3))
    rng = random.Random(4)
    items = [(str(k), prose(rng, n)) for k, n in enumerate((30, 12, 3, 11))] + [("9", "Twice the same"), ("10", "twice THE same")]
    block = decontaminate.Block(items, 10)
    texts = [items[0][1], "x y " + items[2][1] + " z", items[1][1] + " twice the same", "nothing of it " * 20, ""]
    words_ = bytesops.Words(pa.array(texts))
    mask, found = block.scan(words_)
    for d, t in enumerate(texts):
        n, hit, k, *_ = brute_hits(t, items)
        assert (mask[words_.first[d] : words_.first[d + 1]].sum(), len(found[d])) == (hit, k)


def test_a_large_benchmark_and_a_very_long_text(spark):
    """Some 2 MB of items in blocks of 100 kB against a text of 2 MB that holds one of them."""
    rng = random.Random(3)
    items = [(k, prose(rng, 40)) for k in range(6_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "wort " * 400_000 + items[77][1], "en", "s", 1), (2, items[5_999][1], "en", "s", 1), (3, "of the", "en", "s", 1)]
    got = {r["doc_id"]: r for r in decontaminate.report(frame(spark, rows), bench, block_bytes=100_000).collect()}
    assert got[1]["n_words"] == 400_040 and got[1]["n_hit"] == 40 and got[1]["n_items"] == 1 and got[2]["n_hit"] == 40 and not got[3]["contaminated"]


def test_decontaminate_and_cut(spark):
    rows, items, bench = window_case(spark)
    df = frame(spark, rows)
    kept = decontaminate.decontaminate(df, bench)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted((tuple(r) for r in df.collect() if not brute_hits(r["text"], items)[-1]), key=repr)
    cut = decontaminate.remove_spans(df, bench)
    assert cut.columns == df.columns and cut.count() == df.count()
    want = [w for r in rows for w in [brute_hits(r[1], items)]]
    left = sum(len(words(r["text"])) for r in cut.collect())
    assert left == sum(n - h for n, h, *_ in want)


def test_windows_of_nothing(spark):
    df, none = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(df, none).count() == 0
    some = frame(spark, awkward(2, 3))
    assert not decontaminate.report(some, none).where("contaminated").take(1)


def test_hashes_do_not_depend_on_place():
    import pyarrow as pa

    texts = ["alpha beta", "beta", "x " * 700_000 + "beta", "Beta-gamma", ""]
    w = bytesops.Words(pa.array(texts))
    h = w.hashes()
    at = [i for i in range(len(w.start)) if w.word(i) == b"beta"]
    assert len(at) == 4 and len({int(h[i]) for i in at}) == 1
    assert list(w.count) == [2, 1, 700_001, 2, 0]
    win = bytesops.window_hashes(np.tile(h[:2], 10), 4)
    assert len(set(win.tolist())) == 2
