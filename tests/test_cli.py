import pytest
from pyspark.sql import functions as F

from ligaspark import cli
from ligaspark.functions import registered
from ligaspark.operators import adapters
from ligaspark.plans import figures


def put(path, body):
    path.write_text(body)
    return str(path)


def test_sql_functions(spark):
    assert registered.register(spark) == ["align_costs", "align_locate", "find_frag", "revcomp", "site_cuts", "trim_read"]
    assert spark.sql("SELECT align_costs('AG', 'AC') c").first()["c"] == [[0, 0, 0], [0, 0, 1], [0, 1, 1]]
    found = spark.sql("SELECT find_frag(array(100L, 200L, 300L), s, s + 20, 4) f FROM VALUES (10L), (110L), (190L), (400L) t(s)").collect()
    assert [tuple(r["f"]) for r in found] == [(0, "t", -70), (1, "s", 10), (2, "t", -90), (3, "s", 100)]
    linker = "GTCGGATCCTAAGCGCTTAGGATCCGAC"
    cut = spark.sql(f"SELECT trim_read(s, repeat('I', length(s)), '{linker}', 'T^TAA', '') t FROM VALUES ('ACGTACGTACTTA{linker}CCGGCCGGCCGG'), (NULL) v(s)").collect()
    assert tuple(cut[0]["t"]) == (2 | 8, "ACGTACGTACTTAA", "CCGGCCGGCCGG") and cut[1]["t"]["flag"] == 1
    row = spark.sql("SELECT align_locate(r, 'ACGTACGT') a, revcomp(r) b FROM VALUES ('TTTTACGAACGTGGGG'), ('') t(r)").collect()
    assert tuple(row[0]["a"]) == (4, 12, 0, 8, 7, 1) and row[0]["b"] == "CCCCACGTTCGTAAAA" and row[1]["a"]["cost"] is None
    got = spark.sql("SELECT pos FROM VALUES ('TTAATTAAttaa') t(s), LATERAL site_cuts(s, 'TTAA', 1)").collect()
    assert sorted(r["pos"] for r in got) == [1, 5, 9]


def test_verbs(spark, tmp_path):
    run = lambda *a: cli.main([str(x) for x in a], spark)
    fa = put(tmp_path / "g.fa", ">chr1\n" + "ACGGTTAACC" * 30 + "\n>chr2\n" + "GGCCTTAAGC" * 20 + "\n")
    run("extract_fragments", fa, "T^TAA", tmp_path / "sites.bed")
    run("extract_fragments", fa, "T^TAA", tmp_path / "sites.parquet", "--format", "parquet")
    rows = "".join(f"chr1\t{i}\t{i + 20}\tchr{1 + i % 2}\t{i + 30}\t{i + 50}\tn{i}\t0\t+\t-\n" for i in range(0, 120, 3))
    bedpe = put(tmp_path / "a.bedpe", rows)
    run("noise_reduce", bedpe, tmp_path / "sites.bed", tmp_path / "noise")
    assert "normal" in (tmp_path / "noise.types.tsv").read_text()
    run("bedpe2pairs", tmp_path / "noise.normal", tmp_path / "pairs.parquet", "--dedup", "etag")
    run("bedpe2pairs", bedpe, tmp_path / "all.parquet")
    assert spark.read.parquet(str(tmp_path / "all.parquet")).count() == 40
    run("remove_redundancy", bedpe, tmp_path / "dedup", "--distance", 10)
    assert 0 < spark.read.text(str(tmp_path / "dedup")).count() < 40
    run("interactions_qc", bedpe, tmp_path / "comp.txt", "--cutoff", 5)
    assert "total\t40" in (tmp_path / "comp.txt").read_text()
    sizes = put(tmp_path / "sizes", "chr1 300\nchr2 200\n")
    run("chr_interactions", bedpe, sizes, tmp_path / "m.tsv")
    assert (tmp_path / "m.tsv").read_text().splitlines()[0] == "chrom\tchr1\tchr2"
    run("pet_span_dist", bedpe, tmp_path / "span", "--bins", 10)
    run("gen_qc_report", tmp_path / "comp.txt", "--out", tmp_path / "r.html")
    assert "<table>" in (tmp_path / "r.html").read_text() and "<svg" in (tmp_path / "span.svg").read_text()
    run("make_matrix", bedpe, sizes, tmp_path / "matrix", "--resolutions", "50,100")
    run("plot_contact_map", tmp_path / "matrix", tmp_path / "map.svg", "--region", "chr1", "--binsize", "50")
    assert "fill-opacity" in (tmp_path / "map.svg").read_text()
    run("fragment_length_dist", tmp_path / "sites.bed", "--out", tmp_path / "len", "--save")
    run("fragment_length_dist", f"{tmp_path}/sites.bed.lengths", "--out", tmp_path / "len2", "--kind", "kde")
    assert "<polyline" in (tmp_path / "len2.svg").read_text() and len((tmp_path / "len.tsv").read_text().splitlines()) == 2
    run("interactions_qc", put(tmp_path / "empty", "# nothing\n"), tmp_path / "zero.txt")
    assert "total\t0" in (tmp_path / "zero.txt").read_text()
    run("gen_qc_report", tmp_path / "comp.txt", "--out", tmp_path / "r.json", "--format", "json")
    assert '"total": "40"' in (tmp_path / "r.json").read_text()
    for k in (1, 2):
        run("pet_span_dist", bedpe, tmp_path / f"sampled{k}", "--sample", 7)
    assert (tmp_path / "sampled1.describe.tsv").read_text() == (tmp_path / "sampled2.describe.tsv").read_text()
    run("pipeline", tmp_path / "run.ini")
    from ligaspark.plans import config

    assert config.load((tmp_path / "run.ini").read_text()) == config.Config()


def test_reads_to_contacts_verbs(spark, tmp_path):
    run = lambda *a: cli.main([str(x) for x in a], spark)
    linker = "GTCGGATCCTAAGCGCTTAGGATCCGAC"
    fq = put(tmp_path / "r.fq", "".join(f"@q{i}\n{'ACGTACGTACGT'[i % 3:] + 'ACG'}{linker}CCGGCCGGCCGG\n+\n{'I' * (12 - i % 3 + 3 + 28 + 12)}\n" for i in range(9)))
    run("extract_pet", fq, tmp_path / "pets", "--linker-a", linker[:14], "--site", "T^TAA")
    assert "valid\t9" in (tmp_path / "pets" / "qc.txt").read_text()
    run("infer_adapter", fq, "--start", "15", "--n", "9", "--figure", tmp_path / "bases.svg")
    sam = lambda k: "".join(f"q{i}\t0\tchr1\t{10 * i + k}\t30\t12M\t*\t0\t0\tACGT\tIIII\n" for i in range(9))
    run("build_bedpe", put(tmp_path / "1.sam", sam(1)), put(tmp_path / "2.sam", sam(40)), tmp_path / "c.bedpe", "--mapq", "20")
    assert spark.read.text(str(tmp_path / "c.bedpe")).count() == 9


ALIGNER = """import sys
genome = {"chr1": "%s", "chr2": "%s"}
lines = sys.stdin.read().split("\\n")
for name, seq, qual in zip(lines[::4], lines[1::4], lines[3::4]):
    seq = seq[%d:]
    hits = [(c, s.find(seq)) for c, s in genome.items() if seq and s.find(seq) >= 0]
    c, p, flag, q = (hits[0][0], hits[0][1] + 1, 0, 60) if len(hits) == 1 else ("*", 0, 4, 0)
    print(name[1:].split()[0], flag, c, p, q, f"{len(seq)}M" if not flag else "*", "*", 0, 0, lines[lines.index(name) + 1], qual, sep="\\t")
"""


def toy(tmp_path):
    import random

    rng = random.Random(11)
    a, b = ("".join(rng.choice("ACG" if rng.random() < 0.2 else "ACGT") for _ in range(2000)) for _ in range(2))
    programs = []
    for k, skip in enumerate((0, 2)):
        programs.append(put(tmp_path / f"align{k}.py", ALIGNER % (a, b, skip)))
    import sys

    return rng, {"chr1": a, "chr2": b}, ";".join(f"{sys.executable} {p}" for p in programs)


def test_rounds_of_an_aligner_program(spark, tmp_path):
    rng, genome, program = toy(tmp_path)
    at = [rng.randint(0, 1900) for _ in range(20)]
    reads = lambda c, start: "".join(f"@q{i}\n{start if i % 4 == 0 else ''}{genome[c][p : p + 25]}\n+\n{'I' * (27 if i % 4 == 0 else 25)}\n" for i, p in enumerate(at))
    one, two = put(tmp_path / "1.fq", reads("chr1", "NN")), put(tmp_path / "2.fq", reads("chr2", ""))
    cli.main(["build_bedpe", one, two, str(tmp_path / "c.bedpe"), "--aligner", program, "--iterations", "2", "--mapq", "20", "--sinks"], spark)
    from ligaspark.sources import text

    assert text.read_bedpe(spark, str(tmp_path / "c.bedpe")).count() >= 14
    counts = dict(line.split("\t") for line in (tmp_path / "c.bedpe.end1.tsv").read_text().splitlines()[1:])
    assert int(counts["unique"]) >= 18 and text.read_sam(spark, str(tmp_path / "c.bedpe.end1.unique")).count() == int(counts["unique"])


def test_a_failing_aligner_is_an_error(spark):
    from ligaspark.operators import alignments

    reads = spark.createDataFrame([("a", "ACGT", "IIII")], "seqid string, seq string, quality string")
    with pytest.raises(Exception, match="ended with 3"):
        alignments.command_aligner("cat >/dev/null; exit 3")(reads, 0).collect()


def test_the_whole_pipeline_verb(spark, tmp_path):
    rng, genome, program = toy(tmp_path)
    linker, adapter = "GTCGGATCCTAAGCGCTTAGGATCCGAC", "AGATCGGAAGAGCACACGTC"
    rows = []
    for i in range(150):
        (c1, p1), (c2, p2) = [(rng.choice(["chr1", "chr2"]), rng.randint(0, 1900)) for _ in range(2)]
        seq = genome[c1][p1 : p1 + 20] + linker + genome[c2][p2 : p2 + 20] + adapter
        rows.append(f"@r{i}\n{seq}\n+\n{'I' * len(seq)}\n")
    put(tmp_path / "s1.fq", "".join(rows))
    fa = put(tmp_path / "g.fa", "".join(f">{c}\n{s}\n" for c, s in genome.items()))
    cli.main(["extract_fragments", fa, "T^TAA", str(tmp_path / "sites.bed")], spark)
    sizes = put(tmp_path / "sizes.txt", "chr1 2000\nchr2 2000\n")
    ini = put(tmp_path / "run.ini", f"[run]\nfastq = {tmp_path}/*.fq\nsites = {tmp_path}/sites.bed\naligner = {program.split(';')[0]}\nchromosomes = {sizes}\nlinker_a = {linker[:14]}\nadapter = {adapter}\niterations = 2\nresolutions = [500, 1000]\nhic = True\nbalance = True\n")
    cli.main(["pipeline", str(tmp_path / "out"), "--run-config", ini], spark)
    out = tmp_path / "out" / "s1"
    page = (out / "report.html").read_text()
    assert all(f"<h2>{h}</h2>" in page for h in ("Read funnel", "Trimming", "Alignment", "Noise", "Contacts", "Spans", "All counters", "Environment")) and "<path" in page
    n = spark.read.parquet(str(out / "pairs")).count()
    assert n > 80
    from ligaspark import genome as g
    from ligaspark.sources import hic
    from ligaspark.sources.matrix_store import MatrixStore

    assert MatrixStore(spark, str(out / "matrix")).pixels(500).agg(F.sum("count")).first()[0] == n
    cells = [hic.read_hic(spark, str(out / "matrix.hic"), g.Region(a), g.Region(b), width=500).agg(F.sum("count")).first()[0] or 0 for a, b in (("chr1", "chr1"), ("chr1", "chr2"), ("chr2", "chr2"))]
    assert sum(cells) == n


def test_figures_are_loaded(spark, tmp_path):
    from ligaspark.plans import report

    for n in ("chr10", "chr2", "chrX", "1"):
        put(tmp_path / f"{n}.svg", f"<?xml version='1.0'?>\n<svg>{n}</svg>")
    assert report.load_svg(spark, str(tmp_path / "chr2.svg")) == "<svg>chr2</svg>"
    assert [n for n, _ in report.load_chromosome_svgs(spark, str(tmp_path))] == ["1", "chr2", "chr10", "chrX"]
    with pytest.raises(ValueError):
        report.load_svg(spark, put(tmp_path / "x.txt", "none"))


def test_unknown_verb():
    with pytest.raises(SystemExit):
        cli.main(["nothing"])


def test_figures_of_nothing(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert "<svg" in figures.scatter(none, "x", "y")
    freq = adapters.base_frequency(spark.createDataFrame([("ACGT",)], "seq string"))
    assert figures.stacked_bars(freq).count("<rect") == 4
    assert "<rect" in figures.contact_map(spark.createDataFrame([(0, 1, 3.0)], "i long, j long, count double"), 2)
    assert spark.range(1).select(F.lit(1)).count() == 1
