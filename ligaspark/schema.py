"""Schemas of the records that the engine reads and writes, and how a plain-text contact file's kind is told."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType()}


def _of(fields: str) -> T.StructType:
    """From "name type, ..."; needs no running session, as workers import this too."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in fields.split(","))])


FASTQ = _of("seqid string, seq string, quality string")
FASTA = _of("name string, seq string")
BED6 = _of("chr string, start long, end long, name string, score int, strand string")
BEDPE = _of("chr1 string, start1 long, end1 long, chr2 string, start2 long, end2 long, name string, score int, strand1 string, strand2 string")
FRAGMENT_TAGS = _of("tag1 string, dis1 long, tag2 string, dis2 long")
BEDPE_TAGGED = T.StructType(BEDPE.fields + FRAGMENT_TAGS.fields)
PAIRS = _of("name string, chr1 string, pos1 long, chr2 string, pos2 long, strand1 string, strand2 string")
SHORT = _of("chr_a string, pos_a long, chr_b string, pos_b long, score int")
SAM = _of("read_id string, flag int, rname string, pos long, end_pos long, mapq int, seq string, qual string")
SITES = _of("chrom string, pos long")
CHROM_SIZES = _of("chrom string, length long, ord int")
PIXELS = _of("bin1_id long, bin2_id long, count long")
QC = _of("step string, section string, ord int, key string, value string")

#: BEDPE rows of two coordinate styles compare on these; the order is that of the sorts.
BEDPE_KEY = ("chr1", "chr2", "start1", "start2", "end1", "end2", "strand1", "strand2")
PAIRS_KEY = ("chr1", "chr2", "pos1", "pos2", "strand1", "strand2")


def kind_of(line: str) -> str:
    """"bedpe" or "pairs" by the number of fields and whether the coordinates are integers; ValueError for anything else."""
    f = line.split()
    integers = lambda *at: all(f[i].lstrip("-").isdigit() for i in at)
    if len(f) == 7 and integers(2, 4):
        return "pairs"
    if (len(f) == 10 or len(f) >= 14) and integers(1, 2, 4, 5):
        return "bedpe"
    raise ValueError(f"neither BEDPE nor pairs: {len(f)} fields")
