import random

import pytest
from pyspark.sql import functions as F

from ligaspark import genome
from ligaspark.operators import adapters, alignments, contacts, dedup, fragments, matrix, qc, trim
from ligaspark.schema import BEDPE, kind_of


def bedpe(spark, rows):
    return spark.createDataFrame([(a, s, s + 20, b, t, t + 20, n, 0, p, q) for n, (a, s, b, t, p, q) in rows.items()], BEDPE)


def test_orientation(spark):
    df = bedpe(spark, {"a": ("chr2", 5, "chr10", 9, "+", "-"), "b": ("chr1", 9, "chr1", 5, "+", "-"), "c": ("chr1", 5, "chr1", 5, "-", "+")})
    got = {r["name"]: (r["chr1"], r["start1"], r["chr2"], r["start2"], r["strand1"]) for r in contacts.upper_triangle(df).collect()}
    assert got == {"a": ("chr10", 9, "chr2", 5, "-"), "b": ("chr1", 5, "chr1", 9, "-"), "c": ("chr1", 5, "chr1", 5, "-")}
    once = contacts.upper_triangle(df)
    assert sorted(map(tuple, contacts.upper_triangle(once).collect())) == sorted(map(tuple, once.collect()))


def test_kinds():
    assert kind_of("n chr1 5 chr2 9 + -") == "pairs"
    assert kind_of("chr1 1 2 chr2 3 4 n 0 + -") == "bedpe"
    for bad in ("a b c", "chr1 1 2 chr2 3 4 n 0 + - x", "n chr1 x chr2 9 + -"):
        with pytest.raises(ValueError):
            kind_of(bad)


def greedy(rows, d):
    """rows sorted; keeps those that are not within d of the last kept."""
    out, base = [], None
    for r in rows:
        c, xs, st = r[:2], r[2:6], r[6:8]
        if base is None or base[0] != c or base[2] != st or any(abs(a - b) > d for a, b in zip(xs, base[1], strict=True)):
            out.append(r)
            base = (c, xs, st)
    return out


@pytest.mark.parametrize("most", [1, 8, 30])
def test_distance_is_the_scan(spark, most):
    rng = random.Random(most)
    rows = {f"n{i}": (f"chr{rng.randint(1, 2)}", rng.randint(0, 300) * rng.choice([1, 1, 1000]), "chr2", rng.randint(0, 60), rng.choice("+-"), "+") for i in range(400)}
    df = bedpe(spark, rows)
    for parts in (1, 3, 7):
        got = dedup.distance(df.repartition(parts), most)
        keys = sorted((r["chr1"], r["chr2"], r["start1"], r["start2"], r["end1"], r["end2"], r["strand1"], r["strand2"]) for r in got.collect())
        every = sorted((a, b, s, t, s + 20, t + 20, p, q) for a, s, b, t, p, q in rows.values())
        assert keys == sorted(greedy(every, most))


def test_chain_keeps_by_base(spark):
    df = bedpe(spark, {f"n{i}": ("chr1", 8 * i, "chr1", 500, "+", "+") for i in range(3)})
    assert sorted(r["start1"] for r in dedup.dedup(df, "distance", 10).collect()) == [0, 16]


def test_tags_are_needed(spark):
    with pytest.raises(ValueError, match="classify"):
        dedup.strict(bedpe(spark, {"a": ("chr1", 1, "chr1", 2, "+", "+")}))


def test_islands_keep_rows_that_are_apart(spark):
    df = bedpe(spark, {"a": ("chr1", 1, "chr1", 2, "+", "+"), "b": ("chr1", 1, "chr1", 2, "+", "+"), "c": ("chr1", 1, "chr1", 2, "+", "+")})
    tags = {"a": ("5-s", 1, "9-t"), "b": ("5-s", 2, "8-t"), "c": ("5-s", 3, "9-t")}
    m = F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), F.struct(F.lit(v[0]).alias("t1"), F.lit(v[1]).cast("long").alias("d1"), F.lit(v[2]).alias("t2")))])
    df = df.withColumns({"tag1": m[F.col("name")]["t1"], "dis1": m[F.col("name")]["d1"], "tag2": m[F.col("name")]["t2"], "dis2": F.lit(0).cast("long")})
    assert dedup.dedup(df, "etag").count() == 3 and dedup.dedup(df, "etag_strict").count() == 2


def scalar_fragment(sites, start, end, n):
    r = lambda x: sum(p <= x for p in sites)
    if not sites:
        return 0, "s", 0
    fs, fe = r(start + 1), r(end - n - 1)
    lo = max((p for p in sites if p <= start + 1), default=None)
    hi = min((p for p in sites if p > end - n - 1), default=None)
    if fs <= 0:
        return fs, "t", None if hi is None else end - hi
    if hi is None:
        return fe, "s", start - lo
    return (fs, "s", start - lo) if abs(start - lo) < abs(end - hi) else (fe, "t", end - hi)


@pytest.mark.parametrize("method", ["arrays", "bins"])
def test_nearest_fragment(spark, method):
    rng = random.Random(3)
    sites = {"chr1": [100, 200, 300], "chr2": sorted(rng.sample(range(5000), 60)), "chr3": [50]}
    rows = {f"n{i}": (rng.choice(["chr1", "chr2", "chr3", "chr4"]), rng.randint(0, 6000), "chr1", rng.choice([0, 40, 90, 140, 150, 290, 500]), "+", "+") for i in range(300)}
    df = bedpe(spark, rows)
    s = spark.createDataFrame([(c, p) for c, ps in sites.items() for p in ps], "chrom string, pos long")
    for r in fragments.find_fragments(df, s, 4, method).collect():
        for k in (1, 2):
            want = scalar_fragment(sites.get(r[f"chr{k}"], []), r[f"start{k}"], r[f"end{k}"], 4)
            assert (r[f"frag{k}"], r[f"side{k}"], r[f"dis{k}"]) == want, (r, k)


def test_site_scan(spark):
    fa = spark.createDataFrame([("c", "TTAATTAAttaa")], "name string, seq string")
    rows = sorted((r["strand"], r["pos"]) for r in fragments.scan_sites(fa, genome.parse_site("T^TAA")).collect())
    assert rows == [("+", p) for p in (0, 1, 5, 9, 12)]
    fa = spark.createDataFrame([("c", "AAGTGGACTT")], "name string, seq string")
    rows = sorted((r["strand"], r["pos"]) for r in fragments.scan_sites(fa, genome.parse_site("A^AGT")).collect())
    assert rows == [("+", 0), ("+", 1), ("+", 10), ("-", 7)]


SITE = genome.parse_site("T^TAA")
LINKER, ADAPTER = "GTCGGATCCTAAGCGCTTAGGATCCGAC", "AGATCGGAAGAGCACACGTC"


def trimmed(spark, seqs, **how):
    cfg = trim.TrimConfig(how.pop("linkers", (LINKER,)), SITE, mismatch=4, adapter=how.pop("adapter", ADAPTER), **how)
    df = spark.createDataFrame([(f"q{i}", s, "".join(chr(40 + j % 50) for j in range(len(s)))) for i, s in enumerate(seqs)], "seqid string, seq string, quality string")
    return {r["seqid"]: r for r in trim.trim(df, cfg).collect()}


def test_trim_bits(spark):
    good = "ACGTACGTACGT"
    got = trimmed(
        spark,
        [good + LINKER + "CCGGCCGGCCGG" + ADAPTER, "A" * 90, "ACGTACGTACTTA" + LINKER + "TAACCGGCCGGCC" + ADAPTER, "ACG" + LINKER + "GGC" + ADAPTER, "C" * 30 + LINKER + "G" * 30 + ADAPTER, good + LINKER[:9] + "A" + LINKER[10:] + good, ""],
    )
    assert got["q0"]["flag"] == trim.INTRA and got["q0"]["pet1"]["seq"] == good and got["q0"]["pet2"]["seq"] == "CCGGCCGGCCGG"
    assert got["q1"]["flag"] == trim.UNLINKED and got["q1"]["pet1"] is None and got["q1"]["linker"] is not None
    assert got["q2"]["flag"] == trim.INTRA | trim.ADDED_LEFT | trim.ADDED_RIGHT
    assert got["q2"]["pet1"]["seq"].endswith("TTAA") and got["q2"]["pet2"]["seq"].startswith("TTAA")
    assert got["q3"]["flag"] & (trim.LEFT_SHORT | trim.RIGHT_SHORT) == trim.LEFT_SHORT | trim.RIGHT_SHORT
    assert got["q4"]["flag"] & (trim.LEFT_LONG | trim.RIGHT_LONG) == trim.LEFT_LONG | trim.RIGHT_LONG and len(got["q4"]["pet1"]["seq"]) == 20
    assert got["q5"]["linker"]["cost"] == 1 and got["q5"]["pet1"]["seq"] == good
    assert got["q6"]["flag"] == trim.UNLINKED and got["q6"]["linker"] is None
    for r in got.values():
        for pet in (r["pet1"], r["pet2"]):
            assert pet is None or len(pet["seq"]) == len(pet["qual"])


def test_trim_several_linkers(spark):
    linkers = tuple(["GTCGGATCCTAAGCGCTTAGGATCCGAC", "GTCGGTTCCTAAGCGCTTAGGAACCGAC", "GTCGGATCCTAAGCGCTTAGGAACCGAC", "GTCGGTTCCTAAGCGCTTAGGATCCGAC"])
    good = "ACGTACGTACGT"
    reads = [good + x + good for x in linkers] + [good + linkers[1][:0] + "A" + linkers[1][1:] + good]
    got = trimmed(spark, reads, linkers=linkers, adapter="")
    assert [got[f"q{i}"]["flag"] for i in range(4)] == [trim.INTRA, trim.INTRA, 0, 0]
    assert got["q4"]["linker"]["cost"] == 1 and got["q4"]["flag"] == trim.INTRA
    assert trimmed(spark, reads[2:3], linkers=linkers, adapter="", explicit=True)["q0"]["flag"] == trim.INTRA


def test_alignment_rounds(spark):
    reads = spark.createDataFrame([(f"r{i}", "ACGT", "IIII") for i in range(4)], "seqid string, seq string, quality string")

    def align(df, i):
        flag = F.when(F.col("seqid") == f"r{i}", 0).otherwise(4)
        return df.select(F.col("seqid").alias("read_id"), flag.alias("flag"), F.lit("chr1").alias("rname"), F.lit(5).cast("long").alias("pos"), F.lit(9).cast("long").alias("end_pos"), F.lit(30).alias("mapq"), "seq", F.col("quality").alias("qual"))

    unique, counts = alignments.iterate(reads, align, 20, 3)
    assert unique.count() == 3 and counts == [{"unique": 1, "unmapped": 3}, {"unique": 1, "unmapped": 2}, {"unique": 1, "unmapped": 1}]
    pairs = alignments.pair_ends(alignments.to_bed(unique, 20), alignments.to_bed(unique, 20))
    assert pairs.count() == 3


def test_matrix(spark):
    rng = random.Random(1)
    df = contacts.upper_triangle(bedpe(spark, {f"n{i}": (f"chr{rng.randint(1, 2)}", rng.randint(0, 999), f"chr{rng.randint(1, 2)}", rng.randint(0, 999), "+", "+") for i in range(3000)}))
    sizes = genome.chromosome_sizes(spark, [("chr1", 1000), ("chr2", 1000)])
    px = matrix.bin_contacts(df, sizes, 100)
    assert px.agg(F.sum("count")).first()[0] == 3000 == matrix.coarsen(px, sizes, 100, 500).agg(F.sum("count")).first()[0]
    weights = matrix.balance(px, iterations=60, tolerance=1e-10)
    sums = [r["total"] for r in matrix.marginals(matrix.apply_weights(px, weights), "balanced").collect()]
    assert max(sums) / min(sums) < 1.001
    with pytest.raises(ValueError):
        matrix.coarsen(px, sizes, 100, 250)


def test_histogram_of_one_value_and_none(spark):
    one = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    rows = qc.histogram(one, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 0]
    assert qc.histogram(one.where("v is null"), "v", 4).count() == 0
    d = qc.describe(one, "v").first()
    assert d["count"] == 2 and d["mean"] == 5.0


def test_stage_durations(spark):
    lines = ["x @ 01/02/24 10:00:00: START: trim", "noise", "x @ 01/02/24 10:01:30: END: trim", "x @ 01/02/24 11:00:00: START: align"]
    got = {r["stage"]: r["seconds"] for r in qc.stage_durations(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"trim": 90, "align": None}


def test_adapters(spark):
    reads = spark.createDataFrame([(i, "ACGTAC"[: 3 + i % 3] + ADAPTER + "ACGT", "I" * 30) for i in range(60)], "rec_idx long, seq string, quality string")
    assert ADAPTER in adapters.infer_adapter(reads, 60, 0, 0.6, k=8)
    fixed = spark.createDataFrame([(i, "ACGTGA"[i % 6] * 5 + ADAPTER) for i in range(60)], "rec_idx long, seq string")
    assert adapters.infer_adapter(fixed, 60, 5, 0.75) == ADAPTER
    seqs = spark.createDataFrame([("MISSISSIPPI",), ("XSSISSY",), ("ASSISSIPP",)], "seq string")
    assert adapters.longest_common_substring(seqs) == "SSISS"
    assert adapters.longest_common_substring(seqs.limit(0)) == ""


@pytest.mark.parametrize(("low", "high", "want"), [(33, 72, 33), (68, 100, 33), (67, 104, 33), (59, 70, 33)])
def test_phred(spark, low, high, want):
    df = spark.createDataFrame([("".join(map(chr, range(low, high + 1))),)], "quality string")
    assert adapters.infer_phred(df) == want


def test_phred_bad_tails(spark):
    assert adapters.infer_phred(spark.createDataFrame([("BBBBBhhhggg",)], "quality string")) == 64


def test_contacts_on_chromosomes_without_sites_are_dropped(spark):
    df = bedpe(spark, {"a": ("chr1", 90, "chr1", 500, "+", "+"), "b": ("chr9", 5, "chr9", 9, "+", "+"), "c": ("chr1", 5, "chr9", 9, "+", "+"), "d": ("chr9", 5, "chr9", 900, "+", "+"), "e": ("chr9", 5, "chr8", 9, "+", "+")})
    sites = spark.createDataFrame([("chr1", 100), ("chr1", 400)], "chrom string, pos long")
    for method in ("arrays", "bins"):
        assert {r["name"] for r in fragments.classify(df, sites, 4, -1, method).collect()} == {"a"}
        far = {r["name"]: (r["type"], r["frag1"]) for r in fragments.classify(df, sites, 4, 300, method).collect()}
        assert set(far) == {"a", "c", "d", "e"} and far["d"] == ("normal", None)


def test_quantiles_are_exact(spark):
    import numpy as np

    rng = random.Random(4)
    rows = [(rng.choice("ab"), float(rng.choice([rng.gauss(0, 1000), 5, 5, -3]))) for _ in range(900)] + [("c", 7.0), ("d", None), ("e", 1.0), ("e", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for r in qc.describe(df, "v", "g").collect():
        own = [v for g, v in rows if g == r["g"] and v is not None]
        want = [float(x) for x in np.percentile(own, [25, 50, 75])] if own else [None] * 3
        assert [r[k] for k in ("p25", "p50", "p75")] == (pytest.approx(want) if own else want) and r["count"] == len(own)
    every = [v for _, v in rows if v is not None]
    low, high = np.percentile(every, [5, 95])
    assert qc.quantile_trim(df, "v").count() == sum(low < v < high for v in every)
    assert qc.describe(df.limit(0), "v").first()["p50"] is None


def test_norms_even_out_rows(spark):
    rng = random.Random(3)
    cells = [(i, j, rng.randint(1, 40)) for i in range(12) for j in range(i, 12)]
    px = spark.createDataFrame(cells, "bin1_id long, bin2_id long, count long")
    norm = {r["bin_id"]: r["norm"] for r in matrix.knight_ruiz(px).collect()}
    sums = [sum(c / (norm[i] * norm[j]) for i, j, c in cells if k in (i, j)) for k in range(12)]
    mean = sum(c * (1 if i == j else 2) for i, j, c in cells) / 12
    assert max(abs(s - mean) for s in sums) < 1e-7 * mean


def test_knight_ruiz_on_hard_matrices(spark):
    """Rows of very different sizes, a band without a full diagonal, nothing at all, one cell, and a matrix that nothing balances."""
    rng = random.Random(5)
    made = lambda cells: spark.createDataFrame(cells, "bin1_id long, bin2_id long, count long")
    steep = [(i, j, 1 + rng.randint(0, 9) * 10 ** ((i * j) % 5)) for i in range(15) for j in range(i, 15)]
    band = [(i, j, 1 + (i * 7 + j) % 50) for i in range(60) for j in range(i + (i % 3 == 0), min(i + 4, 60))]
    for cells in (steep, band, [(4, 4, 7)]):
        norm = {r["bin_id"]: r["norm"] for r in matrix.knight_ruiz(made(cells)).collect()}
        bins = {k for i, j, _ in cells for k in (i, j)}
        sums = [sum(c / (norm[i] * norm[j]) for i, j, c in cells if k in (i, j)) for k in bins]
        mean = sum(c * (1 if i == j else 2) for i, j, c in cells) / len(bins)
        assert set(norm) == bins and max(abs(s - mean) for s in sums) < 1e-6 * mean
    assert matrix.knight_ruiz(made([])).collect() == [] == matrix.knight_ruiz(made([(1, 2, 0)])).collect()
    assert all(r["norm"] > 0 for r in matrix.knight_ruiz(made([(1, 1, 3), (1, 2, 5)]), iterations=12).collect())  # 2 sees only 1


def test_cost_tables():
    from ligaspark.functions.alignment import cost_table, locate, star_alignment

    rng = random.Random(8)
    for _ in range(20):
        read, query = ("".join(rng.choice("ACG") for _ in range(rng.randint(1, 12))) for _ in range(2))
        table, hit = cost_table(read, query), locate(read, query)
        if hit:
            assert table[hit[3]][hit[1]] == hit[5]
    got = star_alignment(["ACGTACGT", "ACGACGT", "ACGTTACGT", "", "CGTACG"])
    assert len({len(x) for x in got}) == 1 and [x.replace("-", "") for x in got] == ["ACGTACGT", "ACGACGT", "ACGTTACGT", "", "CGTACG"]
    assert star_alignment([]) == []


def test_prefixes_with_wildcards(spark):
    from ligaspark.functions.alignment import compare_prefixes
    from ligaspark.functions.sequences import prefix_agreement

    rng = random.Random(2)
    pairs = [("".join(rng.choice("ACGTNRYacgtX-") for _ in range(rng.randint(0, 9))), "".join(rng.choice("ACGTUNWSacg") for _ in range(rng.randint(0, 9)))) for _ in range(80)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for wild in ((False, False), (True, False), (False, True), (True, True)):
        rows = df.select("a", "b", prefix_agreement(F.col("a"), F.col("b"), *wild).alias("x")).collect()
        assert all(tuple(r["x"]) == compare_prefixes(r["a"], r["b"], *wild) for r in rows)


def test_quantiles_with_far_outliers(spark):
    """Exact whatever the spread, at either end."""
    import numpy as np

    from ligaspark.operators import qc

    rng = np.random.default_rng(3)
    for far in ([1e12], [-1e12], [1e12, -1e12], []):
        x = np.concatenate([rng.exponential(300, 2_000).round(2), np.array(far), [5.0] * 7])
        df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(x)], "v double, g int")
        got = qc.quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}).first()
        assert np.allclose([got[k] for k in "abcde"], np.quantile(x, [0, 0.25, 0.5, 0.99, 1]), rtol=1e-12, atol=1e-9)
        for r in qc.quantiles(df, "v", {"c": 0.5}, "g").collect():
            assert np.isclose(r["c"], np.quantile(x[r["g"] :: 2], 0.5))
