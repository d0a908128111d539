"""The mix is dealt by its slots."""

from llm_data import awkward, frame

from ligaspark.llm import mixing, queries


def test_taken_is_dealt_by_slots(spark, monkeypatch):
    rows = awkward(12, 200)
    called = []
    monkeypatch.setattr(mixing.Mix, "schedule", lambda self, f=mixing.Mix.schedule: called.append(1) or f(self))
    monkeypatch.setattr(queries, "table", lambda *a: frame(spark, rows))
    queries.op10_mix(spark, "").collect()
    assert called


def test_copies_follow_the_schedule(spark):
    rows = [(i, "w " * 50, "en", f"s{i // 100}", 1) for i in range(300)]
    df = frame(spark, rows).coalesce(1)
    got = [r["source"] for r in mixing.repeat_documents(df).collect()]
    n = len(got) // 4
    for s in ("s0", "s1", "s2"):  # each quarter has its share of each source
        for q in range(4):
            assert abs(got[q * n : (q + 1) * n].count(s) - got.count(s) / 4) <= 6


def test_schedule_ranks_slots_one_by_one(spark):
    """Several chunks of slots and many sources: every slot's source by its golden-ratio point, and its rank by counting."""
    rows = [(i, "w " * (3_000 if i % 7 else 9_000), "en", f"s{i % 40:02}", 1) for i in range(240)]
    m = mixing.Mix(frame(spark, rows), block_tokens=8)
    assert m.n_slots > 2 * mixing._CHUNK
    total, ends = sum(m.targets), []
    for t in m.targets:
        ends.append((ends[-1] if ends else 0) + t)
    seen, want = {}, {}
    for slot in range(m.n_slots):
        point = slot * 0x9E3779B97F4A7C15 % 2**64 / 2.0**64
        s = next(i for i, e in enumerate(ends) if point < e / total or i == len(ends) - 1)
        rank = seen[s] = seen.get(s, -1) + 1
        if (left := min(8, m.words[s] - 8 * rank)) > 0:
            want[slot] = (s, rank, left)
    got = {r["slot"]: (r["s"], r["rank"], r["words"]) for r in m.schedule().collect()}
    assert {k: v for k, v in got.items() if k < m.n_slots} == want
    for s, w in enumerate(m.words):
        assert sum(v[2] for v in got.values() if v[0] == s) == w


def test_one_id_on_a_third_of_all_rows(spark):
    """More equal rows than one explode makes: each has its own words of the stream, and the source meets its target."""
    n = mixing._CHUNK + 1_000
    rows = [(7, "a b", "en", "s", 1)] * n + [(i, "c d e", "en", "t" if i % 2 else None, 1) for i in range(2_000)]
    m = mixing.Mix(frame(spark, rows))
    got = m.dealt().where("id = 7 and size = 2").selectExpr("count(*) n", "count(distinct start) d", "sum(taken) t", "max(taken) k").first()
    assert (got["n"], got["d"]) == (n, n) and got["k"] <= 4
    assert got["t"] == m.words[m.names.index("s")]


def check_words(spark, rows):
    """Each source's words in the repeated documents, against its target by the brute-force sharing; every copy whole, every distinct row at most twice per copy."""
    from collections import Counter

    from llm_data import tokens
    from test_packing_and_mixing import reshared

    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len(tokens(r[1])) for r in rows if r[3] == s) for s in names]
    got = [tuple(r) for r in mixing.repeat_documents(frame(spark, rows)).collect()]
    had = Counter(tuple(r) for r in frame(spark, rows).collect())
    assert all(n <= 2 * had[r] for r, n in Counter(got).items())
    for s, target in zip(names, reshared(sizes), strict=True):
        longest = max(len(tokens(r[1])) for r in rows if r[3] == s)
        assert abs(sum(len(tokens(r[1])) for r in got if r[3] == s) - target) <= longest, s
    return Counter(got)


def test_rows_that_share_an_id_and_a_size(spark):
    """Three sources of texts of ten words: two without ids, and one whose rows are alike in every column."""
    text = lambda s, i: " ".join(f"{s}{i}w{k}" for k in range(10))
    rows = [(None, text("a", i), "en", "a", 1) for i in range(1000)] + [(None, text("b", i), "en", "b", 1) for i in range(1000)] + [(i, text("c", i), "en", "c", 1) for i in range(1000)]
    check_words(spark, rows)
    check_words(spark, [(7, text("a", i % 3), None, "a", 1) for i in range(900)] + [(None, text("b", i), "en", None, 1) for i in range(300)] + [(i // 2, text("c", i), "en", "c", 1) for i in range(700)])
    check_words(spark, awkward(13, 80))


def test_many_equal_rows_are_many_keys(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_PLACES", 16)
    taken = check_words(spark, [(7, "a b c", "en", "a", 1)] * 600 + [(i, "d e f g", "en", "b", 1) for i in range(300)])
    assert max(taken.values()) > 300
