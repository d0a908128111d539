"""Sites of sequences in pieces of any width against a scan of whole ones, and mapping against trying every place."""

import random

import pytest

from ligaspark import genome
from ligaspark.operators import fragments, genome_scan, mapping


def in_pieces(spark, seqs, width):
    rows = []
    for k, (name, seq) in enumerate(seqs):
        rows += [("f", k, name, a, seq[a : a + width]) for a in range(0, len(seq), width)] or [("f", k, name, 0, "")]
    return spark.createDataFrame(rows, "file string, record long, name string, start long, seq string")


@pytest.mark.parametrize("site", ["T^TAA", "C^AGT", "A^A", "A^AA", "AC^ACAC", "g^atc"])
def test_pieces_of_any_width(spark, site):
    rng = random.Random(5)
    s = genome.parse_site(site)
    parts = ["A", "AA", "AAA", "ACAC", "AC", "TTAA", "cagt", "ACTG", "gatc", "T", "N"]
    seqs = [(f"c{i}", "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 5, 40])))) for i in range(12)] + [("run", "A" * 101), ("same", "ACACACACACACACACACAC")]
    whole = sorted(map(tuple, fragments.scan_sites(spark.createDataFrame(seqs, "name string, seq string"), s).collect()))
    for width in (1, 2, 3, 7, 1_000):
        assert sorted(map(tuple, genome_scan.scan_pieces(in_pieces(spark, seqs, width), s).collect())) == whole, width


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def best_places(seqs, read, k):
    turned = read[::-1].translate(str.maketrans("ACGT", "TGCA"))
    found = [(edits(seq[a : a + m], r), name, a, a + m, st) for name, seq in seqs for st, r in (("+", read), ("-", turned)) for a in range(len(seq)) for m in range(max(1, len(r) - k), len(r) + k + 1) if a + m <= len(seq)]
    return [f for f in found if f[0] == min(found)[0] <= k] if found else []


@pytest.mark.parametrize("k", [0, 1, 2])
def test_mapping_by_trying_all(spark, k):
    rng = random.Random(k)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = [(f"c{i}", letters(n)) for i, n in enumerate((110, 90, 40, 0, 18))]
    seqs += [("twice", seqs[0][1][:50]), ("poly", "A" * 34 + "N" * 4 + letters(20))]
    reads = []
    for i in range(16):
        seq = rng.choice(seqs[:3])[1]
        a = rng.randrange(len(seq) - 18)
        r = list(seq[a : a + rng.randint(18, 34)])
        for _ in range(rng.randint(0, k + 1)):
            p = rng.randrange(len(r))
            r[p : p + 1] = rng.choice([[], [rng.choice("ACGT")], [r[p], rng.choice("ACGT")]])
        r = "".join(r)
        reads.append((f"r{i}", r if i % 3 else r[::-1].translate(str.maketrans("ACGT", "TGCA")), "I" * len(r)))
    reads += [("poly", "A" * 24, "I" * 24), ("nowhere", "ACGT" * 6, "I" * 24), ("short", "ACG", "III"), ("none", "", ""), ("n", "N" * 30, "I" * 30), reads[0]]
    known = {r: best_places(seqs, r, k) if len(r) >= 6 * (k + 1) else [] for _, r, _ in reads}
    for width in (17, 1_000):
        pieces = in_pieces(spark, seqs, width)
        got = mapping.Index(pieces, 40, 2, 6).map(spark.createDataFrame(reads, "seqid string, seq string, quality string"), k).collect()
        assert sorted((r["read_id"], r["seq"], r["qual"]) for r in got) == sorted(reads)
        for r in got:
            best = known[r["seq"]]
            if not best:
                assert (r["flag"], r["rname"], r["pos"], r["mapq"], r["differences"]) == (4, "*", -1, 0, None), r
                continue
            d, name, a, z, st = min(best)
            lone = len({(b[1], b[4]) for b in best}) == 1 and max(b[2] for b in best) - min(b[2] for b in best) <= k
            assert (r["differences"], r["rname"], r["pos"], r["end_pos"], r["flag"], r["mapq"]) == (d, name, a, z, 16 if st == "-" else 0, 37 if lone else 0), r


def test_limits(spark):
    index = mapping.Index(in_pieces(spark, [("c", "ACGTTGCAGT" * 5)], 50), 20, 1, 6)
    reads = spark.createDataFrame([("r", "ACGTTGCAGTACGTTGCAGTA", "I" * 21)], "seqid string, seq string, quality string")
    with pytest.raises(ValueError, match="21 letters"):
        index.map(reads, 1)
    with pytest.raises(ValueError, match="1 differences"):
        index.map(reads, 2)
    assert index.map(reads.where("false"), 1).count() == 0
