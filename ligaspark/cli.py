"""Command line: ``python -m ligaspark VERB ...``; one verb per tool of the pipeline. Paths may be in any store that the session reads.

Installed packages add verbs by entry points of the group ``ligaspark.verbs``: a function of (spark, arguments), whose attribute ``arguments``, if it has one, is given the verb's
parser.
"""

from __future__ import annotations

import argparse
import sys
import time
from importlib.metadata import entry_points

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.sequences import compose_linkers
from .genome import chromosome_sizes, is_main, parse_region, parse_site
from .operators import adapters, alignments, contacts, dedup, fragments, qc, trim
from .plans import config, figures, report
from .session import session
from .sources import fastx, hic, text
from .sources.hic_writer import write_hic
from .sources.matrix_store import MatrixStore, write_store


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """A small text file through the session's file systems."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(body.encode()))
    out.close()


def _table(spark: SparkSession, path: str, df: DataFrame) -> None:
    rows = df.collect()
    write_text(spark, path, "\t".join(df.columns) + "\n" + "".join("\t".join("." if v is None else str(v) for v in r) + "\n" for r in rows))


def _sizes(spark: SparkSession, which: str) -> DataFrame:
    from .genome import PRESETS

    return chromosome_sizes(spark, which) if which in PRESETS else text.read_chromosomes(spark, which)


def extract_pet(spark, a):
    reads = fastx.read_fastq(spark, a.fastq)
    linkers = a.linkers.split(",") if a.linkers else compose_linkers(a.linker_a, a.linker_b)
    adapter = adapters.infer_adapter(reads) if a.adapter == "auto" else a.adapter
    cfg = trim.TrimConfig(tuple(linkers), parse_site(a.site), a.mismatch, adapter, a.mismatch_adapter, a.shortest, a.longest, a.cut_len, explicit=bool(a.linkers))
    done = trim.trim(reads, cfg)
    done.write.parquet(f"{a.out}/trimmed")
    done = spark.read.parquet(f"{a.out}/trimmed")
    for end in (1, 2):
        fastx.write_fastq(trim.tag_pairs(done, end), f"{a.out}/pet{end}.fq", gz=True)
    text.write_lines(trim.flag_table(done), f"{a.out}/flags", gz=True)
    qc_ = qc.as_sections(trim.flag_counts(done), "trim", "flags")
    for name, df in (("lengths", trim.length_distribution(done)), ("scores", trim.score_distribution(done))):
        _table(spark, f"{a.out}/{name}.tsv", df)
    write_text(spark, f"{a.out}/qc.txt", report.as_text(qc_))


def build_bedpe(spark, a):
    """From the two ends' SAM files, or, with ``--aligner``, from their FASTQ files through a program, in rounds for what stays unmapped; commands are separated
    by semicolons, one for each round. ``--sinks`` keeps each class of alignments as SAM text."""
    beds = []
    for k, path in ((1, a.end1), (2, a.end2)):
        if a.aligner:
            sam, counts = alignments.iterate(fastx.read_fastq(spark, path), alignments.command_aligner(*a.aligner.split(";")), a.mapq, a.iterations)
            rows = [(i, c, n) for i, now in enumerate(counts) for c, n in now.items()]
            table = alignments.rollup(spark.createDataFrame(rows, "round int, class string, count long"))
        else:
            sam = text.read_sam(spark, path)
            table = alignments.class_counts(sam, a.mapq)
        if a.sinks:
            text.write_by_class(sam, a.mapq, f"{a.out}.end{k}")
        _table(spark, f"{a.out}.end{k}.tsv", table)
        beds.append(alignments.to_bed(sam, a.mapq))
    text.write_lines(alignments.pair_ends(*beds), a.out)


def noise_reduce(spark, a):
    done = fragments.classify(text.read_bedpe(spark, a.bedpe), text.read_sites(spark, a.sites), a.site_len, a.threshold)
    cols = [*text.S.BEDPE.names, "tag1", "dis1", "tag2", "dis2"]
    for name, df in fragments.routed(done).items():
        text.write_lines(df.select(*cols), f"{a.out}.{name}")
    _table(spark, f"{a.out}.types.tsv", qc.type_counts(done))
    _table(spark, f"{a.out}.cells.tsv", qc.orientation_cells(done))
    _table(spark, f"{a.out}.distances.tsv", qc.site_distances(done).orderBy("end", "dis"))


def bedpe2pairs(spark, a):
    df = text.read_contacts(spark, a.bedpe)
    if a.dedup:
        df = dedup.dedup(contacts.upper_triangle(df), a.dedup)
    text.write_pairs(contacts.to_pairs(df), a.out)


def remove_redundancy(spark, a):
    df = text.read_contacts(spark, a.input)
    df = df if a.keep_order else contacts.upper_triangle(df)
    text.write_lines(contacts.sort_contacts(dedup.dedup(df, "etag" if a.by_etag else "distance", a.distance)), a.out)


def extract_fragments(spark, a):
    site = parse_site(a.site)
    sites = fragments.scan_sites(fastx.read_fasta(spark, a.fasta), site)
    if a.format == "parquet":
        sites.select("chrom", "strand", "pos", F.lit(site.seq).alias("rest_seq")).write.parquet(a.out)
    else:
        text.write_fragments(fragments.restriction_fragments(sites.where("strand = '+'").select("chrom", "pos")), a.out)


def fragment_length_dist(spark, a):
    """Of fragment tables (BED), or of files of lengths that ``--save`` has written before."""
    parts = []
    for p in a.files:
        own = text.read_lengths(spark, p) if p.rstrip("/").endswith(".lengths") else fragments.fragment_lengths(text.read_bed(spark, p).select(F.col("chr").alias("chrom"), F.col("start").alias("pos")))
        if a.save and not p.rstrip("/").endswith(".lengths"):
            text.write_lengths(own, f"{p.rstrip('/')}.lengths")
        parts.append(own.withColumn("label", F.lit(p)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = qc.quantile_trim(every, "length") if a.trim else every
    stats = qc.describe(every, "length", "label")
    _table(spark, f"{a.out}.tsv", stats)
    if a.kind == "box":
        return write_text(spark, f"{a.out}.svg", figures.boxes(stats, "label", "fragment lengths"))
    some = every.withColumn("_h", F.xxhash64("label", "chrom", "length"))
    drawn = {r["label"]: sorted(r["v"]) for r in some.groupBy("label", F.pmod("_h", F.lit(2_000)).alias("_b")).agg(F.min_by("length", "_h").alias("x")).groupBy("label").agg(F.collect_list("x").alias("v")).collect()}  # 2000 lengths a label at most
    write_text(spark, f"{a.out}.svg", figures.density(drawn, "fragment lengths"))


def infer_adapter(spark, a):
    reads = fastx.read_fastq(spark, a.fastq)
    print(adapters.infer_adapter(reads, a.n, a.start, a.threshold, align=a.align))
    if a.figure:
        write_text(spark, a.figure, figures.stacked_bars(adapters.base_frequency(adapters.first_records(reads, a.n)), "bases by position"))


def plot_contact_map(spark, a):
    region = parse_region(a.region) if a.region else None
    if a.path.endswith(".hic"):
        width = a.binsize or 500_000
        cells = hic.read_hic(spark, a.path, region, width=width, norm="KR" if a.balance else "NONE").select(F.expr(f"x div {width}").alias("i"), F.expr(f"y div {width}").alias("j"), "count")
    else:
        store = MatrixStore(spark, a.path)
        cells = store.fetch(region, resolution=a.binsize, balance=a.balance) if region else store.fetch_all(balance=a.balance)
    size = cells.agg(F.max(F.greatest("i", "j"))).first()[0] or 0
    write_text(spark, a.out, figures.contact_map(cells, size + 1, a.region or "genome"))


def interactions_qc(spark, a):
    """Counts by kind of contact; all zero for a file without records."""
    none = text.lines(spark, a.input).first() is None
    comp = qc.composition(spark.createDataFrame([], text.S.BEDPE) if none else text.read_contacts(spark, a.input), a.cutoff)
    write_text(spark, a.out, report.as_text(qc.as_sections(comp, "contacts", "composition")))


def chr_interactions(spark, a):
    df = text.read_contacts(spark, a.pairs)
    chroms = _sizes(spark, a.chromosomes)
    names = [r["chrom"] for r in chroms.orderBy("ord").collect()]
    wide = qc.pivoted(qc.chromosome_matrix(contacts.on_chromosomes(df, chroms)), names)
    _table(spark, a.out, wide)


def pet_span_dist(spark, a):
    df = text.read_contacts(spark, a.input)
    if a.sample:  # by a hash of the row, so reruns draw the same
        df = df.orderBy(F.xxhash64(*df.columns), *df.columns).limit(a.sample)
    spans = df.select(contacts.intra_span(df).alias("span"))
    _table(spark, f"{a.out}.describe.tsv", qc.describe(spans, "span"))
    hist = qc.histogram(spans, "span", a.bins)
    _table(spark, f"{a.out}.hist.tsv", hist.orderBy("bin"))
    write_text(spark, f"{a.out}.svg", figures.scatter(qc.log_log(hist), "x", "y", "span (log10)"))


def gen_qc_report(spark, a):
    every = None
    for p in a.files:
        part = text.read_sections(spark, p, p.rsplit("/", 1)[-1])
        every = part if every is None else every.unionByName(part)
    write_text(spark, a.out, {"html": report.as_html, "txt": report.as_text, "json": report.as_json}[a.format](every))


def make_matrix(spark, a):
    from .operators import matrix

    sizes = _sizes(spark, a.chromosomes)
    if a.main:
        sizes = sizes.where(is_main(F.col("chrom")))
    resolutions = sorted(int(r) for r in a.resolutions.split(","))
    write_store(matrix.bin_contacts(text.read_contacts(spark, a.pairs), sizes, resolutions[0]), sizes, resolutions[0], resolutions, a.out, a.balance)


def pipeline(spark, a):
    """Without ``--run`` writes a configuration with all defaults; with it, runs the one named: reads to pairs, matrices and a report below ``out``."""
    if not a.run_config:
        return write_text(spark, a.out, "\n".join(["[run]", *(f"{k} = {v!r}" for k, v in vars(config.Config()).items())]) + "\n")
    from .plans import pipeline as whole

    cfg = config.load("\n".join(r["value"] for r in spark.read.text(a.run_config, wholetext=True).collect()))
    config.required(cfg, "fastq", "sites", "aligner")
    sizes = _sizes(spark, cfg.chromosomes)
    names = [r["chrom"] for r in sizes.orderBy("ord").collect()]
    for sample, path in config.find_samples(spark, cfg.fastq).items():
        out, began = f"{a.out}/{sample}", time.time()
        run = whole.run_pipeline(fastx.read_fastq(spark, path), text.read_sites(spark, cfg.sites), alignments.command_aligner(*cfg.aligner.split(";")), cfg, f"{out}/stages")
        middle = time.time()
        text.write_pairs(run.pairs, f"{out}/pairs")
        base = min(cfg.resolutions)
        write_store(run.pixels(sizes, base), sizes, base, cfg.resolutions, f"{out}/matrix", cfg.balance)
        if cfg.hic:
            store = MatrixStore(spark, f"{out}/matrix")
            write_hic(spark, {r: store.pixels(r) for r in cfg.resolutions}, sizes, f"{out}/matrix.hic", cfg.chromosomes)
        times = spark.createDataFrame([("reads to pairs", middle - began), ("matrices", time.time() - middle)], "stage string, seconds double")
        body = whole_page(run, names, times) if cfg.report == "html" else report.as_text(run.qc)
        write_text(spark, f"{out}/report.{'html' if cfg.report == 'html' else 'txt'}", body)


def whole_page(run, names, times) -> str:
    return report.whole_report(run, names, times)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ligaspark", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(f, *positional, **options):
        v = verbs.add_parser(f.__name__)
        v.set_defaults(run=f)
        for name in positional:
            v.add_argument(name, nargs="+") if name == "files" else v.add_argument(name)
        for name, default in options.items():
            flag = "--" + name.replace("_", "-")
            if isinstance(default, bool):
                v.add_argument(flag, action="store_true")
            else:
                v.add_argument(flag, default=default, type=type(default) if default is not None else None)

    verb(extract_pet, "fastq", "out", linkers="", linker_a="", linker_b="", site="A^AGCTT", mismatch=0.12, adapter="", mismatch_adapter=0.3, shortest=10, longest=22, cut_len=20)
    verb(build_bedpe, "end1", "end2", "out", mapq=1, aligner="", iterations=1, sinks=False)
    verb(noise_reduce, "bedpe", "sites", "out", site_len=4, threshold=-1)
    verb(bedpe2pairs, "bedpe", "out", dedup="")
    verb(remove_redundancy, "input", "out", distance=0, by_etag=False, keep_order=False)
    verb(extract_fragments, "fasta", "site", "out", format="tab")
    verb(fragment_length_dist, "files", out="lengths", trim=False, kind="box", save=False)
    verb(infer_adapter, "fastq", n=1000, start=70, threshold=0.75, figure="", align=False)
    verb(plot_contact_map, "path", "out", region="", binsize=0, balance=False)
    verb(interactions_qc, "input", "out", cutoff=20_000)
    verb(chr_interactions, "pairs", "chromosomes", "out")
    verb(pet_span_dist, "input", "out", sample=0, bins=1000)
    verb(gen_qc_report, "files", out="report.html", format="html")
    verb(make_matrix, "pairs", "chromosomes", "out", resolutions="5000,10000,25000,50000,100000,250000,500000,1000000,2500000", balance=False, main=False)
    verb(pipeline, "out", run_config="")
    for entry in sorted(entry_points(group="ligaspark.verbs"), key=lambda e: e.name):
        if entry.name in verbs.choices:
            raise ValueError(f"two verbs are called {entry.name}")
        f = entry.load()
        v = verbs.add_parser(entry.name)
        v.set_defaults(run=f)
        getattr(f, "arguments", lambda parser: None)(v)
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    if getattr(a, "binsize", 1) == 0:
        a.binsize = None
    a.run(spark or session(), a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
