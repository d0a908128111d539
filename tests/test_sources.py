import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from ligaspark import genome
from ligaspark.operators import matrix
from ligaspark.plans import config, pipeline, report
from ligaspark.sources import fastx, hic, text
from ligaspark.sources.matrix_store import MatrixStore, write_store
from ligaspark.streaming import counters


def put(path, body, gz=False):
    data = body.encode()
    path.write_bytes(gzip.compress(data) if gz else data)
    return str(path)


FQ = "@r1 some words\nACGT\n+\n@III\n@r2\nGG\r\n+r2\n#J\r\n@r3\nAC\n"


@pytest.mark.parametrize("gz", [False, True])
def test_fastq(spark, tmp_path, gz):
    p = put(tmp_path / ("a.fq.gz" if gz else "a.fq"), FQ, gz)
    rows = [tuple(r) for r in fastx.read_fastq(spark, p).orderBy("rec_idx").collect()]
    assert rows == [(0, "r1", "ACGT", "@III"), (1, "r2", "GG", "#J")]
    assert text.is_gzip(spark, p) is gz
    both = fastx.read_fastq(spark, p, p)
    assert sorted(r["rec_idx"] for r in both.collect()) == [0, 1, 2, 3] or sorted(r["rec_idx"] for r in both.collect()) == [0, 1, 2, 3]
    fastx.write_fastq(fastx.read_fastq(spark, p).coalesce(1), str(tmp_path / "out"))
    again = fastx.read_fastq(spark, str(tmp_path / "out")).select("seqid", "seq", "quality")
    assert sorted(map(tuple, again.collect())) == [("r1", "ACGT", "@III"), ("r2", "GG", "#J")]
    assert [r["chunk"] for r in fastx.split_records(both, 2).orderBy("rec_idx").collect()] == [0, 0, 1, 1]


def test_fasta(spark, tmp_path):
    p = put(tmp_path / "a.fa", ">chr1 first\nACGT\nAC\n>chr2\nGG\n>empty\n")
    assert sorted(map(tuple, fastx.read_fasta(spark, p).collect())) == [("chr1 first", "ACGTAC"), ("chr2", "GG"), ("empty", "")]
    assert fastx.read_fasta(spark, put(tmp_path / "b.fa", "")).count() == 0


def test_contact_files(spark, tmp_path):
    pairs = put(tmp_path / "a.pairs", "# head\nn#1 chr1 5 chr2 9 + -\nbad line\n  # note\nn2 chr1 x chr2 9 + -\n")
    assert [tuple(r) for r in text.read_contacts(spark, pairs).collect()] == [("n#1", "chr1", 5, "chr2", 9, "+", "-")]
    bed = put(tmp_path / "a.bedpe", "chr1\t1\t2\tchr2\t3\t4\tn\t0\t+\t-\t5-s\t7\t6-t\t-8\n")
    assert text.read_contacts(spark, bed).first()["tag2"] == "6-t" and text.infer_kind(spark, bed) == "bedpe"
    with pytest.raises(OSError):
        text.infer_kind(spark, put(tmp_path / "none", "# only\n"))
    short = put(tmp_path / "s", "chr1 5 chr2 9 1\n")
    assert tuple(text.read_short(spark, short).first()) == ("chr1", 5, "chr2", 9, 1)
    text.write_lines(text.read_bedpe(spark, bed), str(tmp_path / "w"))
    assert text.read_bedpe(spark, str(tmp_path / "w")).count() == 1
    text.write_pairs(text.read_pairs(spark, pairs), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("chr1 = 'chr1'").count() == 1
    assert text.sample_lines(spark, pairs, 2, 1).count() == 2


def test_sam_and_sites(spark, tmp_path):
    p = put(tmp_path / "a.sam", "@HD\tVN:1\nr1\t16\tchr1\t11\t37\t3S10M2D5M1I\t*\t0\t0\tACGT\tIIII\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tGG\tII\n")
    rows = {r["read_id"]: r for r in text.read_sam(spark, p).collect()}
    assert (rows["r1"]["pos"], rows["r1"]["end_pos"], rows["r1"]["mapq"]) == (10, 27, 37) and rows["r2"]["flag"] == 4
    p = put(tmp_path / "f.bed", "# rest_seq: TTAA\nchr1\t0\t10\t.\t0\t+\nchr1\t10\t25\t.\t0\t+\nchr1\t25\t40\t.\t0\t+\n")
    assert sorted(r["pos"] for r in text.read_sites(spark, p).collect()) == [10, 25]
    p = put(tmp_path / "sizes", "chr2 50\nchr1 40\n")
    assert [tuple(r) for r in text.read_chromosomes(spark, p).orderBy("ord").collect()] == [("chr2", 50, 0), ("chr1", 40, 1)]
    assert genome.chromosome_sizes(spark, "mm9").count() == 21 and genome.chromosome_sizes(spark, "hg19").count() == 24
    with pytest.raises(ValueError):
        genome.chromosome_sizes(spark, "none")
    p = put(tmp_path / "qc", "# flags\na\t1\nb\t2\n\n# other\nc\t3\n")
    assert [(r["section"], r["ord"], r["key"]) for r in text.read_sections(spark, p, "x").collect()] == [("flags", 0, "a"), ("flags", 1, "b"), ("other", 0, "c")]


def test_store(spark, tmp_path):
    sizes = genome.chromosome_sizes(spark, [("chr1", 1000), ("chr2", 500)])
    px = spark.createDataFrame([(0, 0, 4), (0, 3, 2), (3, 12, 5), (11, 12, 1)], "bin1_id long, bin2_id long, count long")
    write_store(px, sizes, 100, [100, 500], str(tmp_path / "m"), balanced=True)
    store = MatrixStore(spark, str(tmp_path / "m"))
    assert store.resolutions == [100, 500] and store.lengths == {"chr1": 1000, "chr2": 500}
    assert sorted(map(tuple, store.fetch(genome.Region("chr1"), resolution=100).collect())) == [(0, 0, 4), (0, 3, 2), (3, 0, 2)]
    assert sorted(map(tuple, store.fetch(genome.Region("chr1", 300, 400), genome.Region("chr2"), resolution=100).collect())) == [(0, 2, 5)]
    assert sorted(map(tuple, store.pixels(500).collect())) == [(0, 0, 6), (0, 2, 5), (2, 2, 1)]
    assert store.fetch_all(bins=2).count() > 0 and store.pixels(100, balance=True).where("count is null").count() == 0


class Memory:
    def __init__(self, data):
        self.data = data

    def read_at(self, position, n):
        return self.data[position : position + n]


def make_hic(version, kind):
    """A file with one chromosome of 1000, width 100, one block with cells (1, 2): 3 and (4, 4): 7, and a VC vector."""
    cells = [(1, 2, 3), (4, 4, 7)]
    if version < 7:
        raw = struct.pack("<i", 2) + b"".join(struct.pack("<iif", *c) for c in cells)
    elif kind == 1:
        raw = struct.pack("<iiibb", 2, 0, 0, 0, 1) + struct.pack("<h", 2) + b"".join(struct.pack("<hhhh", y, 1, x, c) for x, y, c in cells)
    else:
        grid = [-32768] * 25
        for x, y, c in cells:
            grid[y * 5 + x] = c
        raw = struct.pack("<iiibb", 2, 0, 0, 0, 2) + struct.pack("<ih", 25, 5) + struct.pack("<25h", *grid)
    block = zlib.compress(raw)
    name = lambda s: s.encode() + b"\0"
    head = lambda master: b"HIC\0" + struct.pack("<iq", version, master) + name("g") + struct.pack("<i", 1) + name("k") + name("v") + struct.pack("<i", 2) + name("All") + struct.pack("<i", 1) + name("1") + struct.pack("<i", 1000) + struct.pack("<ii", 1, 100)
    at = len(head(0))
    meta = struct.pack("<iii", 1, 1, 1) + name("BP") + struct.pack("<i4f", 0, 0, 0, 0, 0) + struct.pack("<iii", 100, 10, 1) + struct.pack("<i", 1)
    matrix_at = at + len(block)
    body = block + meta + struct.pack("<iqi", 0, at, len(block))
    vec_at = at + len(body)
    vec = struct.pack("<i", 10) + struct.pack("<10d", 1, 1, 2, 1, 0, 1, 1, 1, 1, 1)
    body += vec
    foot = struct.pack("<i", 0) + struct.pack("<i", 1) + name("1_1") + struct.pack("<qi", matrix_at, 0) + struct.pack("<i", 1) + name("BP") + struct.pack("<iid", 100, 1, 1.0) + struct.pack("<iid", 1, 0, 1.0) + struct.pack("<i", 0)
    foot += struct.pack("<i", 1) + name("VC") + struct.pack("<i", 1) + name("BP") + struct.pack("<iqi", 100, vec_at, len(vec))
    return head(at + len(body)) + body + foot


@pytest.mark.parametrize(("version", "kind"), [(6, 0), (8, 1), (8, 2)])
def test_hic(spark, tmp_path, version, kind):
    data = make_hic(version, kind)
    (tmp_path / "x.hic").write_bytes(data)
    head = hic.read_header(Memory(data))
    assert (head.version, head.resolutions, head.chromosomes) == (version, [100], [("All", 1), ("1", 1000)])
    rows = sorted(map(tuple, hic.read_hic(spark, str(tmp_path / "x.hic"), genome.Region("chr1"), width=100).collect()))
    assert rows == [(100, 200, 3.0), (400, 400, 7.0)]
    rows = sorted(map(tuple, hic.read_hic(spark, "", genome.Region("1", 0, 250), width=100, norm="VC", source=Memory(data)).collect()))
    assert rows == [(100, 200, 1.5)]
    full = sorted(map(tuple, hic.read_hic(spark, "", genome.Region("1"), width=100, norm="VC", source=Memory(data)).collect()))
    assert full[1] == (400, 400, float("inf"))
    with pytest.raises(ValueError):
        hic.read_header(Memory(b"nothing here"))


def test_config(spark, tmp_path):
    cfg = config.load("[data]\nfastq = a.fq ; where\n[trim]\nmismatch = 4\nresolutions = (1000, 2000)\nlinker_a =\n")
    assert cfg.fastq == "a.fq" and cfg.mismatch == 4 and cfg.resolutions == [1000, 2000] and cfg.linker_a == ""
    for bad in ("[x]\nnothing = 1\n", "[x]\nmapq = 'a'\n"):
        with pytest.raises(ValueError):
            config.load(bad)
    with pytest.raises(ValueError):
        config.required(cfg, "linker_a")
    for n in ("s1.fq", "s2.fastq.gz", "other.txt"):
        (tmp_path / n).write_text("")
    assert list(config.find_samples(spark, str(tmp_path / "*"))) == ["s1", "s2"]


def test_whole_run(spark):
    import random

    rng = random.Random(7)
    chroms = {c: "".join(rng.choice("ACG" if rng.random() < 0.2 else "ACGT") for _ in range(3000)) for c in ("chr1", "chr2")}
    linker, adapter = "GTCGGATCCTAAGCGCTTAGGATCCGAC", "AGATCGGAAGAGCACACGTC"
    reads = []
    for i in range(120):
        (c1, p1), (c2, p2) = [(rng.choice(list(chroms)), rng.randint(0, 2900)) for _ in range(2)]
        reads.append((i, f"r{i}", chroms[c1][p1 : p1 + 18] + linker + chroms[c2][p2 : p2 + 18] + adapter))
    df = spark.createDataFrame(reads, "rec_idx long, seqid string, seq string").withColumn("quality", F.expr("repeat('I', length(seq))"))
    fa = spark.createDataFrame(list(chroms.items()), "name string, seq string")
    from ligaspark.operators import fragments

    sites = fragments.inner_sites(fragments.scan_sites(fa, genome.parse_site("T^TAA")).select("chrom", "pos"))
    cfg = config.Config(linker_a=linker[:14], adapter=adapter, iterations=2)
    run = pipeline.run_pipeline(df, sites, pipeline.exact_aligner(fa, 12), cfg)
    n = run.contacts.count()
    assert n > 100 and run.classified.groupBy("type").count().agg(F.sum("count")).first()[0] == n
    assert 0 < run.pairs.count() <= n
    sizes = genome.chromosome_sizes(spark, [("chr1", 3000), ("chr2", 3000)])
    assert run.pixels(sizes, 500).agg(F.sum("count")).first()[0] == run.pairs.count()
    page, plain = report.as_html(run.qc), report.as_text(run.qc)
    assert "<svg" in page and "composition" in plain and report.environment(spark)


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a.txt", "n1 chr1 5 chr2 9 + -\nn2 chr1 5 chr1 90000 + -\n# c\n")
    put(folder / "b.txt", "n3 chr2 5 chr1 9 + -\n")
    rows = counters.stream_pairs(spark, str(folder))
    q = counters.running_composition(rows).writeStream.outputMode("complete").format("memory").queryName("comp").start()
    q.processAllAvailable()
    q.stop()
    assert tuple(spark.table("comp").first()) == (3, 2, 1, 1)
    q = counters.running_chromosome_counts(rows).writeStream.outputMode("complete").format("memory").queryName("chroms").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("chroms").collect()} == {("chr1", "chr2", 2), ("chr1", "chr1", 1)}


def test_coarsening_by_steps(spark):
    sizes = genome.chromosome_sizes(spark, [("a", 1000), ("b", 450)])
    px = spark.createDataFrame([(i, j, 1) for i in range(15) for j in range(i, 15)], "bin1_id long, bin2_id long, count long")
    both = matrix.zoom(px, sizes, 100, [200, 400]).where("resolution = 400").drop("resolution")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, matrix.coarsen(px, sizes, 100, 400).collect()))
