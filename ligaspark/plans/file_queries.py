"""Registered queries over files: each writes a whole derived table in a format, reads it back through the format's reader, and gives what came back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import genome
from ..functions import registered
from ..operators import adapters, alignments, contacts, dedup, fragments, genome_scan, mapping, matrix, qc, trim
from ..session import work_path, written
from ..sources import bam, fastx, fastx_source, hic, matrices, pair_index, text
from ..sources.hic_writer import write_hic
from ..sources.matrix_store import MatrixStore, write_store
from ..streaming import counters
from . import derive, report
from .registry import (
    _SITE, ORACLES, _ALN, _BIN, _C, _COMP, _K, _KEY, _L, _OWN_SZ, _P, _S, _SZ, _T, _U, _VC, _W, _describe_sql, _expected_sql, _LEN, _off, _own_sizes, _pixels, _px, _reached_sizes, _sizes, _TRIM, _trimmed, _typed, _up, _VALID, query,
)

_COLS = "chr1, start1, end1, chr2, start2, end2, name, score, strand1, strand2"


def _with_quality(df):
    return df.withColumn("quality", F.expr("repeat('I', length(seq))"))


@query("SELECT seqid, seq, repeat('I', len(seq)) AS quality FROM reads", _T)
def fastq_round_trip(s, d):
    path = work_path(s, "fastq")
    fastx.write_fastq(_with_quality(derive.tiles(s, d)), path, gz=True)
    return fastx.read_fastq(s, path).select("seqid", "seq", "quality")


@query("SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) - 1 AS BIGINT) AS last_index FROM reads", _T)
def fastq_numbering(s, d):
    """Records of plain FASTQ files, which Spark reads in blocks, number on without a gap."""
    path = work_path(s, "fastq")
    fastx.write_fastq(_with_quality(derive.tiles(s, d)), path)
    return fastx.read_fastq(s, path).agg(F.count_distinct("rec_idx").alias("records"), F.max("rec_idx").alias("last_index"))


@query("SELECT seqid AS name, seq FROM reads", _W)
def fasta_round_trip(s, d):
    path = work_path(s, "fasta")
    fastx.write_fasta(derive.whole(s, d).select(F.col("seqid").alias("name"), "seq"), path)
    return fastx.read_fasta(s, path)


@query("SELECT concat('chr', doc_id % 5) AS name, count(*) AS sequences, CAST(sum(length(seq)) AS BIGINT) AS letters FROM (SELECT rec_idx AS doc_id, seq FROM reads) e WHERE doc_id % 5 = 2 GROUP BY 1", _W)
def fasta_one_chromosome(s, d):
    path = work_path(s, "index")
    fastx.write_index(derive.whole(s, d).select(F.concat(F.lit("chr"), (F.col("rec_idx") % 5).cast("string")).alias("name"), "seq"), path)
    return fastx.read_chromosome(s, path, "chr2").groupBy("name").agg(F.count(F.lit(1)).alias("sequences"), F.sum(F.length("seq")).alias("letters"))


_BED = "SELECT chrom AS chr, pos AS start, nxt AS \"end\", '.' AS name, 0 AS score, '+' AS strand FROM (SELECT chrom, pos, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS nxt FROM sites) WHERE nxt IS NOT NULL"


@query(_BED, _S)
def bed_round_trip(s, d):
    path = work_path(s, "bed")
    text.write_fragments(fragments.restriction_fragments(derive.sites(s, d)), path)
    return text.read_bed(s, path)


@query("SELECT chrom, pos FROM (SELECT chrom, pos, min(pos) OVER (PARTITION BY chrom) AS a, max(pos) OVER (PARTITION BY chrom) AS z FROM sites) WHERE pos > a AND pos < z", _S)
def site_table_round_trip(s, d):
    path = work_path(s, "fragments.bed")
    text.write_fragments(fragments.restriction_fragments(derive.sites(s, d)), path)
    return text.read_sites(s, path)


@query("SELECT chrom, length FROM lens", _S, _LEN)
def length_cache_round_trip(s, d):
    path = work_path(s, "lengths")
    text.write_lengths(fragments.fragment_lengths(derive.sites(s, d)), path)
    return text.read_lengths(s, path)


@query(f"SELECT chrom, {_describe_sql('length')} FROM lens GROUP BY chrom", _S, _LEN)
def statistics_round_trip(s, d):
    path = work_path(s, "table")
    stats = qc.describe(fragments.fragment_lengths(derive.sites(s, d)), "length", "chrom").withColumn("std", F.round("std", 6))
    stats.repartition(1).write.csv(path, sep="\t", header=True, nullValue=".")
    back = text.read_table(s, path)
    whole = [F.col(c).cast("long").alias(c) if c in ("count", "min", "max") else F.col(c).cast("string" if c == "chrom" else "double").alias(c) for c in back.columns]
    return back.select(*whole)


@query(f"SELECT {_COLS} FROM contacts", _C)
def bedpe_round_trip(s, d):
    path = work_path(s, "bedpe")
    text.write_lines(derive.contacts(s, d).select(*_COLS.split(", ")), path, gz=True)
    return text.read_contacts(s, path)


@query(f"SELECT {_COLS}, tag1, dis1, tag2, dis2 FROM typed WHERE type = 'normal'", _typed("up"))
def classified_sinks_round_trip(s, d):
    """The sink of normal contacts, with fragment tags, read back with them."""
    path = work_path(s, "normal")
    typed = fragments.classify(_up(s, d), derive.sites(s, d, some=True), _L)
    text.write_lines(fragments.routed(typed)[fragments.NORMAL].select(*_COLS.split(", "), "tag1", "dis1", "tag2", "dis2"), path)
    return text.read_contacts(s, path)


@query("SELECT * FROM pairs", _C, _P)
def pairs_round_trip(s, d):
    """Pairs text with comment lines, which hold a mark anywhere before their first word; names may hold one too."""
    path = work_path(s, "pairs")
    rows = contacts.to_pairs(derive.contacts(s, d))
    note = s.createDataFrame([("## pairs format v1.0",), ("  # note a b c d e f",), ("#columns: readID chr1 pos1 chr2 pos2 strand1 strand2",)], "value string")
    note.unionByName(rows.select(F.concat_ws("\t", *rows.columns).alias("value"))).write.text(path)
    return text.read_contacts(s, path)


@query("SELECT count(*) AS lines, 'bedpe' AS kind, TRUE AS gzip FROM contacts", _C)
def sniffed_contacts(s, d):
    """How many lines a sink reports, and what the file is taken for by its first record and its first bytes."""
    path = work_path(s, "contacts")
    n = text.write_lines(derive.contacts(s, d).select(*_COLS.split(", ")), path, gz=True)
    return s.createDataFrame([(n, text.infer_kind(s, path), text.is_gzip(s, path))], "lines long, kind string, gzip boolean")


@query("SELECT chr1, chr2, pos1, pos2, strand1, strand2, name FROM pairs WHERE chr1 = 'chr2' AND chr2 = 'chr3'", _C, _P)
def pairs_sink_pruned(s, d):
    path = work_path(s, "pairs")
    text.write_pairs(contacts.to_pairs(derive.contacts(s, d)), path)
    return s.read.parquet(path).where("chr1 = 'chr2' AND chr2 = 'chr3'").select("chr1", "chr2", "pos1", "pos2", "strand1", "strand2", "name")


@query("SELECT chr1 AS chr_a, (start1 + end1) // 2 AS pos_a, chr2 AS chr_b, (start2 + end2) // 2 AS pos_b, score FROM contacts", _C)
def short_round_trip(s, d):
    path = work_path(s, "short")
    text.write_lines(contacts.to_short(derive.contacts(s, d)), path)
    return text.read_short(s, path)


@query("SELECT read_id, flag, rname, pos, end_pos, mapq FROM aln", _ALN.split(", uq AS")[0])
def sam_round_trip(s, d):
    path = work_path(s, "sam")
    text.write_sam(derive.alignments(s, d).withColumn("cigar", F.lit("5S12M2I3M1D4M9S")), path)
    return text.read_sam(s, path).select("read_id", "flag", "rname", "pos", "end_pos", "mapq")


@query("SELECT CASE WHEN flag & 4 <> 0 THEN 'unmapped' WHEN mapq >= 20 THEN 'unique' ELSE 'other' END AS sink, read_id, flag, mapq FROM aln", _ALN)
def sam_class_sinks(s, d):
    path = work_path(s, "classes")
    text.write_by_class(derive.alignments(s, d), 20, path)
    out = None
    for name in (alignments.UNIQUE, alignments.OTHER, alignments.UNMAPPED):
        part = text.read_sam(s, f"{path}.{name}").select(F.lit(name).alias("sink"), "read_id", "flag", "mapq")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT read_id AS seqid, repeat('A', CAST(l_linenumber AS INT)) AS seq FROM (SELECT concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS read_id, l_linenumber, l_returnflag FROM lineitem) t WHERE l_returnflag = 'R'")
def unmapped_to_fastq(s, d):
    """Unmapped alignments as the reads that the next round of mapping gets."""
    sam = derive.alignments(s, d).withColumns({"seq": F.expr("repeat('A', cast(split(read_id, '_')[1] AS INT))"), "qual": F.expr("repeat('I', cast(split(read_id, '_')[1] AS INT))")})
    path = work_path(s, "fastq")
    fastx.write_fastq(alignments.to_fastq(alignments.by_class(sam, 20)[alignments.UNMAPPED]), path)
    return fastx.read_fastq(s, path).select("seqid", "seq")


@query("SELECT chrom, length, CAST(ord AS INT) AS ord FROM sz", _C, _OWN_SZ)
def chromosome_file(s, d):
    """Chromosomes as long as the contacts reach, by way of a file of lengths."""
    path = work_path(s, "chromosomes")
    _own_sizes(s, d).orderBy("ord").select(F.concat_ws("\t", "chrom", "length").alias("value")).write.text(path)
    return text.read_chromosomes(s, path)


@query("SELECT chr AS chrom, CASE chr WHEN 'chr1' THEN 248956422 WHEN 'chr2' THEN 242193529 WHEN 'chr3' THEN 198295559 WHEN 'chr4' THEN 190214555 WHEN 'chr5' THEN 181538259 END::BIGINT AS length, count(*) AS ends FROM (SELECT unnest([chr1, chr2]) AS chr FROM contacts) GROUP BY 1", _C)
def chromosome_presets(s, d):
    """Ends of contacts on the chromosomes of a preset, read from its file."""
    from ..cli import write_text

    path = work_path(s, "preset")
    write_text(s, path, genome.preset_lines("hg38"))
    ends = derive.contacts(s, d).select(F.explode(F.array("chr1", "chr2")).alias("chrom")).groupBy("chrom").agg(F.count(F.lit(1)).alias("ends"))
    return text.read_chromosomes(s, path).join(ends, "chrom").select("chrom", "length", "ends")


@query("SELECT 'contacts' AS step, 'contacts: composition' AS section, CAST(ord AS INT) AS ord, key, value FROM (SELECT 0 AS ord, 'total' AS key, CAST(total AS VARCHAR) AS value FROM comp UNION ALL SELECT 1, 'inter', CAST(\"inter\" AS VARCHAR) FROM comp UNION ALL SELECT 2, 'intra', CAST(intra AS VARCHAR) FROM comp UNION ALL SELECT 3, 'long_range', CAST(long_range AS VARCHAR) FROM comp)", _C, _U, _COMP)
def qc_sections_round_trip(s, d):
    from ..cli import write_text

    path = work_path(s, "qc")
    write_text(s, path, report.as_text(qc.as_sections(qc.composition(dedup.exact(_up(s, d)), 5000), "contacts", "composition")))
    return text.read_sections(s, path, "contacts")


@query("SELECT part, json_extract_string(j, '$.count') AS count, round(CAST(json_extract_string(j, '$.share') AS DOUBLE), 9) AS share FROM (SELECT part, to_json({'count': count, 'share': share}) AS j FROM (SELECT 'inter' AS part, \"inter\" AS count, CAST(\"inter\" AS DOUBLE) / total AS share FROM comp UNION ALL SELECT 'intra_long', long_range, CAST(long_range AS DOUBLE) / total FROM comp UNION ALL SELECT 'intra_short', intra - long_range, CAST(intra - long_range AS DOUBLE) / total FROM comp))", _C, _U, _COMP)
def qc_as_json(s, d):
    rows = qc.long_short(qc.composition(dedup.exact(_up(s, d)), 5000)).select("part", F.to_json(F.struct("count", "share")).alias("j"))
    back = F.from_json("j", "count string, share double")
    return rows.select("part", back["count"].alias("count"), F.round(back["share"], 9).alias("share"))


@query("SELECT stage, CAST(900 * (k + 1) + 61 AS BIGINT) AS seconds FROM (SELECT concat('stage ', n_name) AS stage, n_nationkey AS k FROM nation)")
def stage_durations(s, d):
    """Times of a run's log, from the lines that say when a stage began and ended."""
    path = work_path(s, "log")
    rows = s.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("stage "), "n_name").alias("stage"), F.col("n_nationkey").alias("k"))
    at = lambda seconds: F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + seconds), "MM/dd/yy HH:mm:ss")
    line = lambda seconds, what: F.concat(F.lit("[INFO] run @ "), at(seconds), F.lit(f": {what}: "), F.col("stage"))
    rows.select(F.explode(F.array(line(F.col("k"), "START"), line(F.col("k") * 901 + 961, "END"), F.lit("other line"))).alias("value")).write.text(path)
    return qc.stage_durations(s.read.text(path)).select("stage", "seconds")


@query(f"SELECT seqid FROM (SELECT seqid, md5(seqid) AS h FROM reads) ORDER BY h, seqid LIMIT 100", _T)  # noqa: F541
def sample_reads(s, d):
    path = work_path(s, "lines")
    derive.tiles(s, d).select(F.col("seqid").alias("value")).write.text(path)
    return text.sample_lines(s, path, 100, order="md5").select(F.col("value").alias("seqid"))


@query("SELECT chunk, count(*) AS reads, min(seqid) AS first FROM (SELECT seqid, CAST((row_number() OVER (ORDER BY rec_idx) - 1) // CAST(ceil((SELECT count(*) FROM reads) / 7) AS BIGINT) AS BIGINT) AS chunk FROM reads) GROUP BY chunk", _T)
def fastq_split(s, d):
    """Reads in seven runs of consecutive records, by their numbers in the order of the table."""
    path = work_path(s, "fastq")
    fastx.write_fastq(_with_quality(derive.tiles(s, d)).orderBy("rec_idx"), path)
    split = fastx.split_records(fastx.read_fastq(s, path), 7)
    return split.groupBy("chunk").agg(F.count(F.lit(1)).alias("reads"), F.min("seqid").alias("first"))


# ---------------------------------------------------------------- matrices


@query("SELECT bin1_id - 200 AS i, bin2_id - 200 AS j, count FROM (SELECT * FROM px UNION ALL SELECT bin2_id, bin1_id, count FROM px WHERE bin1_id <> bin2_id) WHERE bin1_id BETWEEN 200 AND 219 AND bin2_id BETWEEN 200 AND 219", _C, _SZ, _off(_BIN), _px(_BIN))
def matrix_store_fetch(s, d):
    path = work_path(s, "store")
    write_store(_pixels(s, d), _sizes(s), _BIN, [_BIN, 500_000], path)
    return MatrixStore(s, path).fetch(genome.Region("chr2", 0, 2_000_000), resolution=_BIN)


@query("SELECT CAST(resolution AS INT) AS resolution, chrom, length, CAST(ceil(length / resolution) AS BIGINT) AS bins FROM sz, (VALUES (100000), (500000)) v(resolution)", _SZ)
def matrix_store_metadata(s, d):
    path = work_path(s, "store")
    write_store(_pixels(s, d), _sizes(s), _BIN, [_BIN, 500_000], path)
    store = MatrixStore(s, path)
    rows = [(r, c, n) for r in store.resolutions for c, n in store.lengths.items()]
    names = s.createDataFrame(rows, "resolution int, chrom string, length long")
    bins = None
    for r in store.resolutions:
        part = store.bins(r).groupBy("chrom").agg(F.count(F.lit(1)).alias("bins")).withColumn("resolution", F.lit(r))
        bins = part if bins is None else bins.unionByName(part)
    return names.join(bins, ["resolution", "chrom"])


_HIC = "cells AS (SELECT least(start1, start2) // 500000 * 500000 AS x, greatest(start1, start2) // 500000 * 500000 AS y FROM contacts WHERE chr1 = 'chr2' AND chr2 = 'chr2')"


def _hic_file(s, d, norms=None, sizes=None):
    path = work_path(s, "matrix") + ".hic"
    sizes = _sizes(s) if sizes is None else sizes
    base = written(matrix.bin_contacts(derive.contacts(s, d), sizes, 100_000))
    coarse = written(matrix.coarsen(base, sizes, 100_000, 500_000))
    write_hic(s, {100_000: base, 500_000: coarse}, sizes, path, "derived", norms(coarse) if norms else None)
    return path


@query("SELECT x, y, CAST(count(*) AS DOUBLE) AS count FROM cells WHERE x BETWEEN 0 AND 20000000 GROUP BY x, y", _C, _HIC)
def hic_round_trip(s, d):
    """Cells of which one end lies in the first 20 million letters, however far the contacts reach."""
    path = _hic_file(s, d, sizes=_reached_sizes(s, d))
    return hic.read_hic(s, path, genome.Region("chr2", 0, 20_000_000), genome.Region("chr2"), width=500_000)


@query("SELECT (least(start1, start2) // 100000) * 100000 AS x, (greatest(start1, start2) // 100000) * 100000 AS y, CAST(count(*) AS DOUBLE) AS count FROM contacts WHERE chr1 = 'chr3' AND chr2 = 'chr3' AND (least(start1, start2) // 100000) * 100000 BETWEEN 300000 AND 1200000 AND (greatest(start1, start2) // 100000) * 100000 BETWEEN 300000 AND 1200000 GROUP BY 1, 2", _C)
def hic_region(s, d):
    return hic.read_hic(s, _hic_file(s, d), genome.Region("chr3", 300_000, 1_200_000), width=100_000)


@query("SELECT (bin1_id - 40) * 500000 AS x, (bin2_id - 40) * 500000 AS y, round(count / (a.norm * b.norm), 6) AS count FROM px JOIN nm a ON a.bin_id = bin1_id JOIN nm b ON b.bin_id = bin2_id WHERE bin1_id BETWEEN 40 AND 79 AND bin2_id BETWEEN 40 AND 79", _C, _SZ, _off(500_000), _px(500_000), _VC)
def hic_normalized(s, d):
    """Counts of a ``.hic`` file divided by the vectors that it holds."""

    def vectors(pixels):
        sums = matrix.marginals(pixels)
        return {"VC": {500_000: sums.join(F.broadcast(sums.agg(F.avg("total").alias("m")))).select("bin_id", (F.col("total") / F.col("m")).alias("norm"))}}

    return hic.read_hic(s, _hic_file(s, d, vectors), genome.Region("chr2"), width=500_000, norm="VC").withColumn("count", F.round("count", 6))


@query("SELECT (bin1_id - a) * 500000 AS x, (bin2_id - a) * 500000 AS y, round(count * f / e, 6) AS count FROM nr JOIN ex USING (dist) JOIN fc USING (chrom), (SELECT \"offset\" AS a FROM o WHERE chrom = 'chr2') WHERE chrom = 'chr2'", _C, _SZ, _off(500_000), _px(500_000), _expected_sql())
def hic_over_expected(s, d):
    """Counts of a ``.hic`` file over the expected counts that it holds."""
    return hic.read_hic(s, _hic_file(s, d), genome.Region("chr2"), width=500_000, over_expected=True).withColumn("count", F.round("count", 6))


@query("SELECT 'derived' AS genome, CAST(8 AS INT) AS version, 'chr1,chr2,chr3,chr4,chr5' AS chromosomes, '500000,100000' AS resolutions")
def hic_header(s, d):
    h = hic.read_header(hic.HadoopFile(s, _hic_file(s, d)))
    return s.createDataFrame([(h.genome, h.version, ",".join(c for c, _ in h.chromosomes[1:]), ",".join(map(str, h.resolutions)))], "genome string, version int, chromosomes string, resolutions string")


@query("SELECT kind, bin1_id - 200 AS i, bin2_id - 200 AS j, CAST(count AS DOUBLE) AS count FROM (SELECT * FROM px UNION ALL SELECT bin2_id, bin1_id, count FROM px WHERE bin1_id <> bin2_id), (VALUES ('hic'), ('store')) v(kind) WHERE bin1_id BETWEEN 200 AND 201 AND bin2_id BETWEEN 200 AND 219", _C, _SZ, _off(_BIN), _px(_BIN))
def matrix_backends(s, d):
    """The same rectangle, between places within bins, through the one reader of both formats."""
    path = work_path(s, "store")
    write_store(_pixels(s, d), _sizes(s), _BIN, [_BIN], path)
    one, two = genome.Region("chr2", 50_000, 150_000), genome.Region("chr2", 0, 1_950_000)
    parts = [matrices.open_matrix(s, p).fetch(one, two, resolution=_BIN).select(F.lit(k).alias("kind"), "i", "j", F.col("count").cast("double").alias("count")) for k, p in (("store", path), ("hic", _hic_file(s, d)))]
    return parts[0].unionByName(parts[1])


_RECT = "chr1 = '{}' AND pos1 >= 2000 AND pos1 < 90000 AND chr2 = '{}' AND pos2 >= 10000 AND pos2 < 150000"


@query(f"SELECT * FROM pairs WHERE {_RECT.format('chr2', 'chr2')} OR (chr1 = 'chr2' AND pos1 >= 10000 AND pos1 < 150000 AND chr2 = 'chr2' AND pos2 >= 2000 AND pos2 < 90000)", _C, _P)
def pair_index_rectangle(s, d):
    """Pairs with one end in each of two regions, from a layout by the Z-curve of both positions."""
    path = work_path(s, "pair-index")
    pair_index.write_index(contacts.to_pairs(derive.contacts(s, d)), path)
    return pair_index.read_index(s, path, genome.Region("chr2", 2_000, 90_000), genome.Region("chr2", 10_000, 150_000))


# ---------------------------------------------------------------- sorts, splits and funnels


@query("SELECT chr1, start1, end1, name FROM contacts ORDER BY CAST(substr(chr1, 4) AS INT), start1, end1, name", _C)
def sort_by_first_end(s, d):
    return contacts.sort_by_first(derive.contacts(s, d), "name").select("chr1", "start1", "end1", "name")


@query(f"SELECT {_KEY}, name, score FROM up ORDER BY {_KEY}", _C)
def merge_sorted_runs(s, d):
    up = _up(s, d)
    runs = [contacts.sort_contacts(up.where(F.pmod(F.xxhash64("name"), F.lit(3)) == k)) for k in range(3)]
    return contacts.merge_sorted(*runs)


@query("SELECT part, count(*) AS contacts FROM (SELECT CASE WHEN chr1 <> chr2 THEN 'across' ELSE 'within' END AS part FROM contacts) GROUP BY part", _C)
def split_by_predicate(s, d):
    across, within = qc.split_by(derive.contacts(s, d), contacts.is_inter())
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("contacts")).select(F.lit(name).alias("part"), "contacts")
    return one(across, "across").unionByName(one(within, "within"))


_FUNNEL = f"SELECT CAST(ord AS INT) AS ord, step, CAST(count AS BIGINT) AS count, CAST(count AS DOUBLE) / raw AS ratio FROM (SELECT count(*) AS raw FROM x2), (SELECT 0 AS ord, 'raw' AS step, count(*) AS count FROM x2 UNION ALL SELECT 1, 'linker', count(*) FROM x2 UNION ALL SELECT 2, 'same_linker', count(*) FROM x2 UNION ALL SELECT 3, 'across_linkers', NULL UNION ALL SELECT 4, 'valid', count(*) FROM x2 WHERE {_VALID} UNION ALL SELECT 5, 'mapped', count(*) FROM contacts UNION ALL SELECT 6, 'non_redundant', total FROM comp UNION ALL SELECT 7, 'inter', \"inter\" FROM comp UNION ALL SELECT 8, 'intra', intra FROM comp)"


@query(_FUNNEL, _C, _U, _COMP, _K, _TRIM)
def whole_read_funnel(s, d):
    """All nine steps, from reads to contacts; one linker cannot tell reads across linkers, so that step is null."""
    mapped = derive.contacts(s, d).agg(F.count(F.lit(1)).alias("mapped"))
    return qc.read_funnel(trim.flag_counts(_trimmed(s, d)), mapped, qc.composition(dedup.exact(_up(s, d)), 5000))


@query("SELECT \"end\", count, CAST(count AS DOUBLE) / (SELECT count(*) FROM aln) AS ratio FROM (SELECT 'end1' AS \"end\", count(*) AS count FROM uq WHERE pos % 2 = 0 UNION ALL SELECT 'end2', count(*) FROM uq WHERE pos % 2 = 1 UNION ALL SELECT 'paired', count(*) FROM contacts)", _C, _ALN)
def alignment_ratios(s, d):
    """Unique alignments of either end over the reads that went in: ends are told by an odd or even position here."""
    sam = derive.alignments(s, d)
    unique = alignments.by_class(sam, 20)[alignments.UNIQUE]
    ends = unique.agg(F.count_if(F.col("pos") % 2 == 0).alias("end1"), F.count_if(F.col("pos") % 2 == 1).alias("end2"))
    paired = derive.contacts(s, d).agg(F.count(F.lit(1)).alias("paired"))  # one row each
    return qc.alignment_ratios(ends.join(F.broadcast(paired)), sam.count())


@query("SELECT symbol, count(*) AS count FROM (SELECT unnest(string_split(concat(repeat(chr(CAST(64 + rec_idx % 40 AS INT)), CAST(greatest(len(seq) - 1, 0) AS INT)), 'B'), '')) AS symbol FROM reads) GROUP BY symbol ORDER BY count DESC, symbol LIMIT 4", _W)
def commonest_symbols(s, d):
    quality = F.concat(F.expr("repeat(char(64 + rec_idx % 40), cast(greatest(length(seq) - 1, 0) AS INT))"), F.lit("B"))
    return adapters.common_symbols(derive.whole(s, d).select(quality.alias("quality")))



# ---------------------------------------------------------------- streams and SQL functions


def _streamed(s, df, mode):
    """What a stream over all files that are there gives in the end, by way of files: rows as they come, or the last state of all of them."""
    out = work_path(s, "streamed")
    q = df.writeStream.outputMode(mode).option("checkpointLocation", work_path(s, "checkpoint")).trigger(availableNow=True)
    if mode == "append":
        q = q.format("parquet").option("path", out)
    else:
        q = q.foreachBatch(lambda state, _: state.write.mode("overwrite").parquet(out))
    q.start().awaitTermination()
    return s.read.schema(df.schema).parquet(out)


_PAIRS_A_FILE = 500_000


def _pair_files(s, d):
    path = work_path(s, "arriving")
    pairs = contacts.to_pairs(derive.contacts(s, d))
    n = max(6, -(-pairs.count() // _PAIRS_A_FILE))  # where there are more than six, more of them arrive at once
    pairs.repartition(n).select(F.concat_ws("\t", *pairs.columns).alias("value")).write.text(path)
    return counters.stream_pairs(s, path, files_per_trigger=n // 3)


@query("SELECT count(*) AS total, count(*) FILTER (chr1 <> chr2) AS \"inter\", count(*) FILTER (chr1 = chr2) AS intra, count(*) FILTER (chr1 = chr2 AND abs(pos2 - pos1) >= 20000) AS long_range FROM pairs", _C, _P)
def streamed_composition(s, d):
    """Counters over files that arrive two at a time, of large tables a third of them at a time."""
    return _streamed(s, counters.running_composition(_pair_files(s, d)), "complete")


@query("SELECT DISTINCT chr1, chr2, pos1, pos2, strand1, strand2 FROM pairs", _C, _P)
def streamed_unique_pairs(s, d):
    rows = _pair_files(s, d).withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000)))
    return _streamed(s, counters.unique_pairs(rows, "arrived"), "append").select("chr1", "chr2", "pos1", "pos2", "strand1", "strand2")


@query(f"SELECT seqid, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, CAST(b AS INT) AS at, flag FROM x2", _K, _TRIM)  # noqa: F541
def sql_functions(s, d):
    """The functions that are registered for SQL text."""
    registered.register(s)
    reads = _with_quality(derive.tiles(s, d, linked=True))
    cut = f"trim_read(seq, quality, '{derive.LINKER}', 'T^TAA', '{derive.ADAPTER}').flag"
    return s.sql(f"SELECT seqid, revcomp(seq) AS rc, align_locate(seq, '{derive.LINKER}').ref_start AS at, {cut} AS flag FROM {{reads}}", reads=reads)


@query("SELECT seqid AS name, CAST(len(array_to_string(list_slice(p, 1, k), 'TTAA')) + 1 AS BIGINT) AS pos FROM (SELECT seqid, p, unnest(range(1, len(p))) AS k FROM (SELECT seqid, string_split(seq, 'TTAA') AS p FROM reads))", _W)
def sql_table_function(s, d):
    registered.register(s)
    return s.sql("SELECT seqid AS name, pos FROM {reads}, LATERAL site_cuts(seq, 'TTAA', 1)", reads=derive.whole(s, d))


# ---------------------------------------------------------------- data sources


@query("SELECT read_id, flag, CASE WHEN flag & 4 <> 0 THEN '*' ELSE rname END AS rname, CASE WHEN flag & 4 <> 0 THEN -1 ELSE pos END AS pos, CASE WHEN flag & 4 <> 0 THEN -1 ELSE pos + 18 END AS end_pos, mapq, CASE WHEN flag & 4 <> 0 THEN '*' ELSE '5S12M2I3M1D2N9S' END AS cigar, seq, qual FROM (SELECT *, translate(md5(read_id), '0123456789abcdef', 'ACGTNACGTNACGTNA') AS seq, translate(md5(read_id), '0123456789abcdef', '!+5?IJ~ABCDEFGHK') AS qual FROM aln) s", _ALN.split(", uq AS")[0])
def bam_round_trip(s, d):
    """Alignments as BAM files, read by tasks that begin anywhere in them."""
    path = work_path(s, "bam")
    lost, digest = F.col("flag").bitwiseAND(4) != 0, F.md5("read_id")
    sam = derive.alignments(s, d).withColumns({"seq": F.translate(digest, "0123456789abcdef", "ACGTNACGTNACGTNA"), "qual": F.translate(digest, "0123456789abcdef", "!+5?IJ~ABCDEFGHK")})
    sam = sam.withColumns({"cigar": F.when(lost, "*").otherwise("5S12M2I3M1D2N9S"), "rname": F.when(lost, "*").otherwise(F.col("rname")), "pos": F.when(lost, -1).otherwise(F.col("pos"))})
    bam.write_bam(sam, path, derive.SIZES)
    return bam.read_bam(s, path, "read_id string, flag int, rname string, pos long, end_pos long, mapq int, cigar string, seq string, qual string", split_bytes=1 << 20)


@query("SELECT seqid, seq, repeat('I', len(seq)) AS quality FROM reads", _T)
def fastq_source(s, d):
    """Reads of plain files cut into many stretches, in one scan."""
    path = work_path(s, "fastq")
    fastx.write_fastq(_with_quality(derive.tiles(s, d)), path)
    return fastx_source.read_fastq(s, path, "seqid string, seq string, quality string", split_bytes=1 << 20)


@query("SELECT length(seq) AS length, count(*) AS reads FROM reads GROUP BY 1", _T)
def fastq_stream(s, d):
    """Reads of a folder of files as a stream, written to files, counted by length."""
    path, out = work_path(s, "fastq"), work_path(s, "reads")
    fastx.write_fastq(_with_quality(derive.tiles(s, d)), path)
    q = fastx_source.stream_fastq(s, path, "seqid string, seq string").writeStream.format("parquet").option("checkpointLocation", work_path(s, "checkpoint")).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return s.read.schema("seqid string, seq string").parquet(out).groupBy(F.length("seq").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def _pieces(s, d, piece=1_000):
    path = work_path(s, "fasta")
    fastx.write_fasta(derive.whole(s, d).select(F.col("seqid").alias("name"), "seq"), path)
    return fastx_source.read_pieces(s, path, piece)


@query("SELECT seqid AS name, len(seq) AS letters, CAST(greatest(1, ceil(len(seq) / 1000)) AS BIGINT) AS pieces, md5(substr(seq, 1, 1000)) AS first FROM reads", _W)
def fasta_pieces(s, d):
    """Sequences as pieces of a thousand letters at most."""
    pieces = _pieces(s, d).groupBy("file", "record", "name").agg(F.sum(F.length("seq")).cast("long").alias("letters"), F.count(F.lit(1)).alias("pieces"), F.md5(F.max(F.when(F.col("start") == 0, F.col("seq")))).alias("first"))
    return pieces.select("name", "letters", "pieces", "first")


@query(ORACLES["restriction_scan"])
def restriction_scan_pieces(s, d):
    return genome_scan.scan_pieces(_pieces(s, d), _SITE)


@query(ORACLES["restriction_scan_both_strands"])
def restriction_scan_pieces_both_strands(s, d):
    return genome_scan.scan_pieces(_pieces(s, d), genome.parse_site("C^AGT"))


_MAP = f"""genome AS ({derive.GENOME}), reads AS MATERIALIZED ({derive.GENOME_READS}), rs AS (SELECT seqid, '+' AS strand, seq AS r FROM reads UNION ALL SELECT seqid, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM reads),
w AS MATERIALIZED (SELECT name, a, substr(seq, a + 1, 33) AS t FROM (SELECT name, seq, unnest(range(0, len(seq))) AS a FROM genome)),
hit AS MATERIALIZED (SELECT seqid, strand, name, a, a + len(r) + v AS z, levenshtein(substr(t, 1, len(r) + v), r) AS diff FROM rs, w, (VALUES (-2), (-1), (0), (1), (2)) x(v) WHERE len(r) + v <= len(t) AND levenshtein(substr(t, 1, len(r) + v), r) <= 2)"""


def _mapped_sql(k: int) -> str:
    return f"""m{k} AS (SELECT seqid, diff, arg_min(struct_pack(name, a, z, strand), (name, a, z, strand)) AS p, count(DISTINCT (name, strand)) = 1 AND max(a) - min(a) <= {k} AS lone
  FROM hit WHERE diff = (SELECT min(diff) FROM hit h WHERE h.seqid = hit.seqid) AND diff <= {k} GROUP BY seqid, diff)"""


def _index(s, d):
    return mapping.Index(derive.genome(s, d).select("name", F.lit(0).alias("start"), "seq"), 40, 2, 9)


@query("SELECT r.seqid AS read_id, CASE WHEN p IS NULL THEN 4 WHEN p.strand = '-' THEN 16 ELSE 0 END AS flag, coalesce(p.name, '*') AS rname, coalesce(p.a, -1) AS pos, coalesce(p.z, -1) AS end_pos, CASE WHEN lone THEN 37 ELSE 0 END AS mapq, CAST(diff AS INT) AS differences FROM reads r LEFT JOIN m2 USING (seqid)", _MAP, _mapped_sql(2))
def map_with_differences(s, d):
    """Reads within two substitutions, insertions or deletions of places of the benchmark's texts."""
    found = _index(s, d).map(_with_quality(derive.genome_reads(s, d)), 2)
    return found.select("read_id", "flag", "rname", "pos", "end_pos", "mapq", "differences")


@query("SELECT CAST(round AS INT) AS round, class, count(*) AS count FROM (" + " UNION ALL ".join(f"SELECT {k} AS round, CASE WHEN m.seqid IS NULL THEN 'unmapped' WHEN lone THEN 'unique' ELSE 'other' END AS class FROM reads r LEFT JOIN m{k} m USING (seqid)" + (f" WHERE r.seqid NOT IN (SELECT seqid FROM m{k - 1})" if k else "") for k in range(3)) + ") GROUP BY 1, 2", _MAP, *[_mapped_sql(k) for k in range(3)])
def mapping_rounds(s, d):
    """Iterative mapping: round i allows i differences, and only what is unmapped goes on."""
    _, counts = alignments.iterate(_with_quality(derive.genome_reads(s, d)), _index(s, d).aligner(), 20, 3)
    return s.createDataFrame([(i, c, n) for i, now in enumerate(counts) for c, n in now.items()], "round int, class string, count long")
