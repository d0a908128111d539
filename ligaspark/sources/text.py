"""Plain-text records (gzip by suffix, as Spark reads it): BED, BEDPE, pairs, short, SAM, site and chromosome lists; readers with fixed schemas, and writers.

Lines are split on any white space and written with tabs; comment lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators.alignments import by_class, parse_sam
from ..operators.contacts import sort_bed, sort_contacts, without_marks


def lines(spark: SparkSession, path: str) -> DataFrame:
    return without_marks(spark.read.text(path)).where(F.trim("value") != "")


def parse(rows: DataFrame, fields: T.StructType, least: int | None = None) -> DataFrame:
    """Leading fields of each line, cast; lines with fewer than ``least`` fields, or with an integer that is none, are dropped."""
    at = F.split(F.trim("value"), r"\s+")
    made = [F.try_element_at(at, F.lit(i + 1)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    out = rows.where(F.size(at) >= (least or len(fields))).select(*made)
    numbers = [F.col(f"`{f.name}`").isNotNull() for f in fields.fields[: least or len(fields)] if f.dataType != T.StringType()]
    for ok in numbers:
        out = out.where(ok)
    return out


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return parse(lines(spark, path), S.BED6)


def read_bedpe(spark: SparkSession, path: str, tags: bool = False) -> DataFrame:
    return parse(lines(spark, path), S.BEDPE_TAGGED if tags else S.BEDPE)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    rows = lines(spark, path)
    return parse(rows.where(F.size(F.split(F.trim("value"), r"\s+")) == 7), S.PAIRS)


def read_short(spark: SparkSession, path: str) -> DataFrame:
    return parse(lines(spark, path), S.SHORT)


def infer_kind(spark: SparkSession, path: str) -> str:
    """"bedpe" or "pairs" from the first line that is no comment; OSError for a file without one."""
    first = lines(spark, path).first()
    if first is None:
        raise OSError(f"{path} has no records")
    return S.kind_of(first["value"])


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """BEDPE or pairs, whichever it is; fragment tags are read if they are there."""
    first = lines(spark, path).first()
    if infer_kind(spark, path) == "pairs":
        return read_pairs(spark, path)
    return read_bedpe(spark, path, tags=len(first["value"].split()) >= 14)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a SAM text file; positions are 0-based, ends exclusive."""
    return parse_sam(spark.read.text(path))


def write_sam(sam: DataFrame, path: str) -> None:
    """Alignments as SAM text without a header. Where there is no CIGAR the whole stretch counts as matched."""
    has = lambda c, other: F.coalesce(F.col(c).cast("string"), F.lit(other)) if c in sam.columns else F.lit(other)
    lost = F.col("flag").bitwiseAND(4) != 0
    cigar = F.col("cigar") if "cigar" in sam.columns else F.when(lost, "*").otherwise(F.concat((F.col("end_pos") - F.col("pos")).cast("string"), F.lit("M")))
    fields = [F.col("read_id"), F.col("flag").cast("string"), F.coalesce("rname", F.lit("*")), F.coalesce(F.col("pos") + 1, F.lit(0)).cast("string"), F.col("mapq").cast("string"), F.coalesce(cigar, F.lit("*")), F.lit("*"), F.lit("0"), F.lit("0"), has("seq", "*"), has("qual", "*")]
    sam.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)


def write_by_class(sam: DataFrame, mapq: int, path: str) -> None:
    """A folder of SAM text for each class of alignments: ``path.unique``, ``path.other``, ``path.unmapped``."""
    for name, part in by_class(sam, mapq).items():
        write_sam(part, f"{path}.{name}")


def write_lengths(lengths: DataFrame, path: str) -> None:
    """Fragment lengths (chrom, length) as lines of a chromosome and up to 4 096 of its lengths."""
    rows = lengths.withColumn("_b", F.monotonically_increasing_id()).withColumn("_b", F.expr("_b div 4096"))
    line = rows.groupBy("chrom", "_b").agg(F.concat_ws("\t", F.collect_list(F.col("length").cast("string"))).alias("v"))
    line.select(F.concat_ws("\t", "chrom", "v").alias("value")).write.text(path)


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length) from lines of a chromosome and its lengths, as many as there are."""
    at = F.col("at")  # a column of its own below the explosion, so that a line is split once and not for each of its lengths
    rows = lines(spark, path).select(F.split(F.trim("value"), r"\s+").alias("at")).select(at[0].alias("chrom"), F.explode(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0)))).alias("v"))
    return rows.select("chrom", F.col("v").try_cast("long").alias("length")).where("length is not null")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a line of names, numbers as such and a dot for what is absent: statistics that a verb has written."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=True, nullValue=".")


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos) strictly inside chromosomes, from a fragment table (BED; starts) or from Parquet of positions with bounds."""
    from ..operators.fragments import inner_sites

    if ".bed" in path or path.endswith((".txt", ".gz", ".tab")):
        bed = read_bed(spark, path)
        return inner_sites(bed.select(F.col("chr").alias("chrom"), F.col("start").alias("pos")).union(bed.select("chr", "end")).distinct())
    return inner_sites(spark.read.parquet(path).select("chrom", "pos"))


def read_chromosomes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length, ord) in the order of the file, which is small."""
    rows = [r["value"].split() for r in lines(spark, path).collect()]
    return spark.createDataFrame([(r[0], int(r[1]) if len(r) > 1 else None, i) for i, r in enumerate(rows)], S.CHROM_SIZES)


def read_sections(spark: SparkSession, path: str, step: str) -> DataFrame:
    """A QC text file (``# title`` headings, tab-separated keys and values, blocks apart by blank lines) as the long QC table."""
    out, section, ord_ = [], "", 0
    for r in spark.read.text(path).collect():  # a report of a few hundred lines
        line = r["value"].rstrip()
        if line.startswith("#"):
            section, ord_ = line.lstrip("# ").strip(), 0
        elif "\t" in line:
            key, value = line.split("\t", 1)
            out.append((step, section, ord_, key, value))
            ord_ += 1
    return spark.createDataFrame(out, S.QC)


def write_lines(df: DataFrame, path: str, gz: bool = False) -> int:
    """Rows as lines of tab-separated fields, a dot for what is null; gives their number, which the write itself counts."""
    seen = Observation()
    text = df.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")) for c in df.columns]).alias("value"))
    text.observe(seen, F.count(F.lit(1)).alias("n")).write.text(path, compression="gzip" if gz else "none")
    return seen.get["n"]


def write_pairs(df: DataFrame, path: str) -> None:
    """Sorted pairs as Parquet by chromosome pair, which region and pair queries prune."""
    sort_contacts(df).write.partitionBy("chr1", "chr2").parquet(path)


def write_fragments(bed: DataFrame, path: str) -> None:
    write_lines(sort_bed(bed), path)


def sample_lines(spark: SparkSession, path: str, n: int, seed: int = 0, order: str = "xxhash64") -> DataFrame:
    """``n`` lines at random, all if there are fewer; the same for the same seed and content. ``order``: the hash they are drawn by; md5 takes no seed."""
    h = F.md5("value") if order == "md5" else F.xxhash64(F.col("value"), F.lit(seed))
    return spark.read.text(path).orderBy(h, "value").limit(n)


def is_gzip(spark: SparkSession, path: str) -> bool:
    """By the first two bytes."""
    row = spark.read.format("binaryFile").load(path).select(F.hex(F.substring("content", 1, 2)).alias("h")).first()
    return row is not None and row["h"] == "1F8B"
