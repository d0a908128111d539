"""FASTQ and FASTA, read through Spark's text source, so from any store and compressed as it may be.

A record is four lines by number, as a quality line may begin with any character. Lines are numbered per file, from line counts of the file's blocks; a trailing
partial record is dropped. All of it is Spark's own expressions: lines go through no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _numbered(spark: SparkSession, paths: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(file, f, block, n, value): lines with their numbers in their file, and the file's number; and the blocks. A block of a file is read in order by one task, so its lines' numbers are its first line's and
    on; the blocks, a row for each read of a store, are the only thing that is summed up. ``file`` is the number of its path and its full name."""
    raw = None
    for i, path in enumerate(paths):
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # its number in the task
        part = spark.read.text(path).select("value", F.struct(F.lit(i).alias("i"), F.col("_metadata.file_path").alias("f")).alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("id"))
        raw = part if raw is None else raw.unionByName(part)
    blocks = raw.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    number = F.dense_rank().over(Window.orderBy("file"))
    blocks = blocks.select("file", number.alias("f"), "block", "first", "lines", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("base"))
    rows = raw.join(F.broadcast(blocks), ["file", "block"]).select("file", "f", "block", (F.col("base") + F.col("id") - F.col("first")).alias("n"), "value")
    return rows, blocks


def read_fastq(spark: SparkSession, *paths: str) -> DataFrame:
    """(rec_idx, seqid, seq, quality); the id is the header's first word without its mark. Indexes count on from one path to the next, in a folder by name; a folder's files each
    hold whole records."""
    rows, blocks = _numbered(spark, paths)
    part = rows.where("n % 4 <> 2").groupBy("f", F.expr("n div 4").alias("r")).agg(
        *[F.max(F.when(F.expr("n % 4") == k, F.rtrim(F.col("value")))).alias(name) for k, name in ((0, "head"), (1, "seq"), (3, "quality"))]
    )
    part = part.where(F.col("quality").isNotNull())
    counts = blocks.groupBy("f").agg(F.expr("sum(lines) div 4").alias("_k"))  # a row per file
    before = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("f", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    return part.join(F.broadcast(bases), "f").select((F.col("r") + F.col("_base")).alias("rec_idx"), F.substring_index(F.regexp_replace(F.split("head", r"\s+")[0], "^@", ""), " ", 1).alias("seqid"), "seq", "quality")


def write_fastq(df: DataFrame, path: str, gz: bool = False) -> None:
    record = F.concat(F.lit("@"), F.col("seqid"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("quality"))
    df.select(record.alias("value")).write.text(path, compression="gzip" if gz else "none")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq): the whole header after its mark, and all of its lines joined. A record is assembled in one place: a chromosome at most."""
    rows, _ = _numbered(spark, (path,))
    head = F.startswith("value", F.lit(">"))
    per = rows.groupBy("file", "block").agg(F.count_if(head).alias("k"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = per.select("file", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    upto = Window.partitionBy("file", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(bases, ["file", "block"]).withColumn("r", F.col("base") + F.sum(head.cast("long")).over(upto))
    out = rows.where("r > 0").groupBy("file", "r").agg(F.max(F.when(head, F.expr("substring(value, 2, length(value))"))).alias("name"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("n", F.trim("value").alias("v"))))), lambda x: x["v"]), "").alias("seq"))
    return out.select("name", "seq")


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """Records of (name, seq) with lines of ``width`` letters."""
    lines = F.array_join(F.regexp_extract_all("seq", F.lit(f".{{1,{width}}}"), F.lit(0)), "\n")
    df.select(F.concat(F.lit(">"), F.col("name"), F.when(F.col("seq") != "", F.concat(F.lit("\n"), lines)).otherwise(F.lit(""))).alias("value")).write.text(path)


def write_index(fasta: DataFrame, path: str) -> None:
    """Sequences as Parquet by name, so that one chromosome is read without the others."""
    fasta.withColumn("chrom", F.split("name", r"\s+")[0]).write.partitionBy("chrom").parquet(path)


def read_chromosome(spark: SparkSession, path: str, chrom: str) -> DataFrame:
    """(name, seq) of one chromosome of :func:`write_index`'s; the others' files are not opened."""
    return spark.read.parquet(path).where(F.col("chrom") == chrom).select("name", "seq")


def split_records(df: DataFrame, n: int) -> DataFrame:
    """Records with ``chunk``: n runs of consecutive records, all of one size but the last."""
    total = df.count()
    size = max(1, -(-total // n))
    return df.withColumn("chunk", F.expr(f"rec_idx div {size}"))
