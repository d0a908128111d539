"""Alignments of read ends: classes, BED rows, pairing of ends, and the rollup of iterative mapping."""

from __future__ import annotations

import subprocess
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .contacts import upper_triangle

UNIQUE, UNMAPPED, OTHER = "unique", "unmapped", "other"


def alignment_class(mapq: int) -> Column:
    lost = F.col("flag").bitwiseAND(4) != 0
    return F.when(lost, UNMAPPED).when(F.col("mapq") >= mapq, UNIQUE).otherwise(OTHER)


def class_counts(sam: DataFrame, mapq: int) -> DataFrame:
    return sam.groupBy(alignment_class(mapq).alias("class")).agg(F.count(F.lit(1)).alias("count"))


def to_bed(sam: DataFrame, mapq: int) -> DataFrame:
    """BED rows of the unique alignments."""
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")
    return sam.where(alignment_class(mapq) == UNIQUE).select(F.col("rname").alias("chr"), F.col("pos").alias("start"), F.col("end_pos").alias("end"), F.col("read_id").alias("name"), F.col("mapq").alias("score"), strand.alias("strand"))


def to_fastq(sam: DataFrame) -> DataFrame:
    """Reads as they are stored."""
    return sam.select(F.col("read_id").alias("seqid"), "seq", F.col("qual").alias("quality"))


def pair_ends(bed1: DataFrame, bed2: DataFrame) -> DataFrame:
    """Canonical contacts of two ends with the same name; names that repeat pair many to many."""
    end = lambda bed, k: bed.select("name", *[F.col(c).alias(f"{c}{k}") for c in ("chr", "start", "end", "strand")])
    both = end(bed1, 1).join(end(bed2, 2), "name")
    return upper_triangle(both.select("chr1", "start1", "end1", "chr2", "start2", "end2", "name", F.lit(0).alias("score"), "strand1", "strand2"))


def iterate(first: DataFrame, align: Callable[[DataFrame, int], DataFrame], mapq: int, rounds: int) -> tuple[DataFrame, list[dict]]:
    """Unique alignments of all rounds, and each round's counts by class. Only unmapped reads go on, each round with a looser aligner; it ends when a round
    finds nothing or leaves nothing. Each round's alignments are written, so the aligner runs once a round; the tables stay until the result has been used."""
    unique, counts, reads = None, [], first
    for i in range(rounds):
        sam = written(align(reads, i))
        now = {r["class"]: r["count"] for r in class_counts(sam, mapq).collect()}
        counts.append(now)
        part = sam.where(alignment_class(mapq) == UNIQUE)
        unique = part if unique is None else unique.unionByName(part)
        if not now.get(UNIQUE) or not now.get(UNMAPPED):
            break
        reads = to_fastq(sam.where(alignment_class(mapq) == UNMAPPED))
    return unique, counts


def by_class(sam: DataFrame, mapq: int) -> dict[str, DataFrame]:
    """The alignments of each class, for sinks of their own."""
    return {c: sam.where(alignment_class(mapq) == c) for c in (UNIQUE, OTHER, UNMAPPED)}


def command_aligner(*commands: str) -> Callable[[DataFrame, int], DataFrame]:
    """An aligner that runs a program on each executor: FASTQ on its standard input, SAM text on its output. Round k runs ``commands[k]``, later ones the last. A
    task's reads are one run of the program; a failed one fails the task, which Spark tries again elsewhere."""

    def align(reads: DataFrame, k: int) -> DataFrame:
        command = commands[min(k, len(commands) - 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with subprocess.Popen(["/bin/sh", "-c", command], stdin=subprocess.PIPE, stdout=subprocess.PIPE) as p:

                def feed():
                    with p.stdin as out:
                        for batch in batches:
                            for s, q, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                                out.write(f"@{s}\n{q}\n+\n{t}\n".encode())

                feeder = threading.Thread(target=feed)
                feeder.start()
                held: list[str] = []
                for line in p.stdout:
                    held.append(line.decode().rstrip("\n"))
                    if len(held) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["value"])
                        held = []
                feeder.join()
                if p.wait():
                    raise RuntimeError(f"{command!r} ended with {p.returncode}")
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

        return parse_sam(reads.select("seqid", "seq", "quality").mapInArrow(run, "value string"))

    return align


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that a CIGAR covers: lengths of M, D, N, = and X."""
    parts = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(F.transform(parts, lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments of SAM text; positions are 0-based, ends exclusive."""
    rows = lines.where(~F.startswith("value", F.lit("@"))).where("value <> ''")
    at = F.split("value", "\t")
    g = lambda i: F.get(at, F.lit(i))
    pos = g(3).cast("long") - 1
    return rows.select(g(0).alias("read_id"), g(1).cast("int").alias("flag"), g(2).alias("rname"), pos.alias("pos"), (pos + reference_length(g(5))).alias("end_pos"), g(4).cast("int").alias("mapq"), g(9).alias("seq"), g(10).alias("qual"))


def rollup(counts: DataFrame) -> DataFrame:
    """Counts of rounds (round, class, count) as one: unique and other are added up, unmapped is the last round's."""
    last = F.max_by("count", "round")
    per = counts.groupBy("class").agg(F.sum("count").alias("_s"), last.alias("_l"))
    return per.select("class", F.when(F.col("class") == UNMAPPED, F.col("_l")).otherwise(F.col("_s")).alias("count"))
