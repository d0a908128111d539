import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ligaspark.functions.alignment import compare_prefixes, locate, locate_many
from ligaspark.functions.sequences import all_starts, compose_linkers, reverse_complement, reverse_complement_text, site_starts
from ligaspark.genome import Region, choose_resolution, parse_region, parse_site, proper_unit


def cell_by_cell(read, query):
    """The alignment table in plain Python."""
    m, n = len(read), len(query)
    t = {(i, 0): (0, 0, -i) for i in range(m + 1)} | {(0, j): (0, 0, j) for j in range(1, n + 1)}
    for j in range(1, n + 1):
        for i in range(1, m + 1):
            diag, up, left = t[i - 1, j - 1], t[i - 1, j], t[i, j - 1]
            if read[i - 1] == query[j - 1]:
                t[i, j] = (diag[0], diag[1] + 1, diag[2])
            else:
                b = diag if diag[0] <= min(up[0], left[0]) else up if up[0] <= left[0] else left
                t[i, j] = (b[0] + 1, b[1], b[2])
    best = None
    for i, j in [(m, j) for j in range(1, n + 1)] + [(i, n) for i in range(m + 1)]:
        cost, same, origin = t[i, j]
        n_ref = i + min(origin, 0)
        if n_ref >= 1 and cost <= n_ref and (best is None or same > best[4] or (same == best[4] and cost < best[5])):
            best = (max(-origin, 0), i, max(origin, 0), j, same, cost)
    return best


@pytest.mark.parametrize(
    ("read", "query", "want"),
    [("TTTTACGAACGTGGGG", "ACGTACGT", (4, 12, 0, 8, 7, 1)), ("TTTTACGTACGTGGGG", "ACGTACGT", (4, 12, 0, 8, 8, 0)), ("MISSISSIPPI", "SISSI", (3, 8, 0, 5, 5, 0)), ("", "ACGT", None), ("AAAAAAAA", "CCCC", (7, 8, 0, 1, 0, 1))],
)
def test_probes(read, query, want):
    assert locate(read, query) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ACGT", max_size=18), min_size=1, max_size=6), st.text("ACGT", min_size=1, max_size=10))
def test_aligner_is_the_table(reads, query):
    got = locate_many(reads, query)
    for r, g in zip(reads, got, strict=True):
        want = cell_by_cell(r, query) if r else None
        assert (tuple(map(int, g)) if g[1] >= 0 else None) == want


def test_random_reads_have_no_linker():
    rng = random.Random(5)
    reads = ["".join(rng.choice("ACGT") for _ in range(100)) for _ in range(300)]
    linker = "".join(rng.choice("ACGT") for _ in range(40))
    assert not any(0 <= g[5] <= 4 for g in locate_many(reads, linker) if g[1] >= 0)


def test_prefixes():
    assert compare_prefixes("ACGT", "ACCTT") == (0, 4, 0, 4, 3, 1)
    assert compare_prefixes("ACNT", "ACGT", wildcard_ref=True) == (0, 4, 0, 4, 4, 0)


def test_reverse_complement(spark):
    df = spark.createDataFrame([("AACGTNacgtn",), ("AXC",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(reverse_complement(F.col("s"))).collect()]
    assert got == ["nacgtNACGTT", "G\0T", "", None]
    assert reverse_complement_text("AACGTNacgtn") == "nacgtNACGTT"


@given(st.text("ACGTNacgtn"))
def test_reverse_complement_twice(s):
    assert reverse_complement_text(reverse_complement_text(s)) == s


def test_linkers():
    assert compose_linkers("GTC") == ["GTCGAC"] == compose_linkers("GTC", "GTC")
    assert compose_linkers("AA", "CG") == ["AATT", "CGCG", "AACG", "CGTT"]


def test_site_starts(spark):
    df = spark.createDataFrame([("TTAATTAAttaa",), ("GG",), ("",)], "s string")
    assert [r[0] for r in df.select(site_starts(F.col("s"), "TTAA")).collect()] == [[0, 4, 8], [], []]
    df = spark.createDataFrame([("ATATATTAA",)], "s string")
    assert df.select(site_starts(F.col("s"), "ATAT")).first()[0] == [0]
    assert df.select(all_starts(F.col("s"), "ATAT")).first()[0] == [0, 2]


def test_sites_and_regions(spark):
    s = parse_site("T^TAA")
    assert (s.seq, s.cut, s.left, s.middle, s.right) == ("TTAA", 1, "T", "TA", "A")
    assert parse_site("A*AGCTT").seq == "AAGCTT"
    for bad in ("TTAA", "^TTAA", "TTA^A"):
        with pytest.raises(ValueError):
            parse_site(bad)
    r = parse_region("chr1:1,000-2,000")
    assert r == Region("chr1", 1000, 2000) and str(r) == "chr1:1000-2000" and parse_region("chrX") == Region("chrX")
    assert Region("chr1", 1200, 1300) in r and r not in Region("chr1", 1200, 1300) and r in Region("chr1") and Region("chr1") not in r
    for bad in ("", "chr1:1", "chr1:5-2", "a b c d"):
        with pytest.raises(ValueError):
            parse_region(bad)
    assert choose_resolution(1_000_000, [1000, 2000, 5000]) == 2000 and choose_resolution(10, [1000, 5000]) == 1000
    df = spark.createDataFrame([(2_500_000,), (3_000_000,), (500,), (25_000,)], "n long")
    assert [r[0] for r in df.select(proper_unit(F.col("n"))).collect()] == ["2M500K", "3M", "0K", "25K"]


def plain_trim(seq, cfg):
    """(flag, first tag, second tag) of one read, by the scalar table and one rule after another."""
    linker, adapter, site = cfg.linkers[0], cfg.adapter, cfg.site
    at = seq.find(linker)
    hit = (at, at + len(linker), 0, 0, 0, 0) if at >= 0 else cell_by_cell(seq, linker) if seq else None
    if hit is None or hit[5] > cfg.linker_cost:
        return 1, None, None
    flag, b, c, z, rest = 2, hit[0], hit[1], len(seq), seq[hit[1] :]
    found = cell_by_cell(rest, adapter) if rest else None
    if found is None or found[5] / len(adapter) >= float(np.float32(cfg.adapter_cost / len(adapter))):  # a limit in single precision, a share in double
        flag |= 4
    else:
        z = c + found[0]
    a = 0
    flag |= 64 if b - a > cfg.longest else 32 if b - a < cfg.shortest else 0
    flag |= 256 if z - c > cfg.longest else 128 if z - c < cfg.shortest else 0
    left = seq[b - cfg.cut_len : b] if b > cfg.longest else seq[:b]
    right = seq[c : c + cfg.cut_len] if z - c > cfg.longest else seq[c:z]
    if left.endswith(site.left + site.middle):
        flag, left = flag | 8, left + site.right
    if right.startswith(site.middle + site.right):
        flag, right = flag | 16, site.left + right
    return flag, left, right


def test_trimming_is_the_rules():
    """Reads with exact, changed, cut and absent linkers and adapters."""
    from ligaspark.operators import trim

    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    linker, adapter = "GTCGGATCCTAAGC", "AGATCGGAAG"
    cfg = trim.TrimConfig((linker,), parse_site("T^TAA"), mismatch=3, adapter=adapter, mismatch_adapter=4)

    def worn(s):
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            i = rng.randrange(len(s))
            s = s[:i] + rng.choice(["", "A", "CG", "T"]) + s[i + 1 :]
        return s or "A"

    reads = ["", "A", linker, linker[3:], word(90)] + [word(rng.randint(0, 30)) + rng.choice(["", "TTA"]) + worn(linker) + rng.choice(["", "TAA"]) + word(rng.randint(0, 30)) + rng.choice([worn(adapter), ""]) for _ in range(250)]
    flag, left, right, *_ = trim.trim_reads(reads, ["I" * len(r) for r in reads], cfg)
    got = list(zip(flag.tolist(), left.field(0).to_pylist(), right.field(0).to_pylist(), strict=True))
    want = [plain_trim(r, cfg) for r in reads]
    assert [(r, g, w) for r, g, w in zip(reads, got, want, strict=True) if g != w] == []
    assert len({w[0] for w in want}) > 15
