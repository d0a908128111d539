"""From reads to matrices and QC. Each stage is written once, as Parquet below the run's folder, and read by all that come after it.

The aligner is a function that the caller gives: ``align(reads, round) -> SAM rows``; :func:`exact_aligner` is a small built-in one for tests and toy genomes, and
:func:`ligaspark.operators.alignments.command_aligner` runs a program.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import compose_linkers, reverse_complement
from ..genome import parse_site
from ..operators import adapters, alignments, contacts, dedup, fragments, matrix, qc, trim
from ..session import work_path
from .config import Config


@dataclass
class Run:
    """All stages of a run, as they have been written."""

    trimmed: DataFrame
    contacts: DataFrame
    classified: DataFrame
    pairs: DataFrame
    qc: DataFrame
    rounds: dict[str, list[dict]]
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def pixels(self, sizes: DataFrame, binsize: int) -> DataFrame:
        return matrix.bin_contacts(self.pairs, sizes, binsize)


def trim_config(reads: DataFrame, cfg: Config) -> trim.TrimConfig:
    linkers = cfg.linkers or compose_linkers(cfg.linker_a, cfg.linker_b)
    adapter = cfg.adapter
    if adapter == "auto":
        adapter = adapters.infer_adapter(reads, cfg.adapter_reads, cfg.adapter_start, cfg.adapter_threshold)
    return trim.TrimConfig(tuple(linkers), parse_site(cfg.restriction_site), cfg.mismatch, adapter, cfg.mismatch_adapter, cfg.shortest, cfg.longest, cfg.cut_len, explicit=bool(cfg.linkers))


def run_pipeline(reads: DataFrame, sites: DataFrame, align: Callable[[DataFrame, int], DataFrame], cfg: Config, out: str | None = None) -> Run:
    """``reads``: (rec_idx, seqid, seq, quality); ``sites``: (chrom, pos). Stages go below ``out``, or below a work folder of the session."""
    spark = reads.sparkSession
    out = (out or work_path(spark, "run")).rstrip("/")

    def stage(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    how = trim_config(reads, cfg)
    trimmed = stage("trimmed", trim.trim(reads, how))
    beds, rounds = [], {}
    for end in (1, 2):
        unique, rounds[f"end{end}"] = alignments.iterate(trim.tag_pairs(trimmed, end), align, cfg.mapq, cfg.iterations)
        beds.append(stage(f"end{end}", alignments.to_bed(unique, cfg.mapq)))
    paired = stage("contacts", alignments.pair_ends(*beds))
    classified = stage("classified", fragments.classify(paired, sites, len(how.site.seq), cfg.threshold_span))
    normal = classified.where(F.col("type") == fragments.NORMAL)
    final = dedup.dedup(normal, cfg.dedup if cfg.threshold_span == -1 or not cfg.dedup.startswith("etag") else "exact")
    pairs = stage("pairs", contacts.to_pairs(final))

    flags, last = trim.flag_counts(trimmed), qc.composition(pairs, cfg.long_range)
    uniques = beds[0].agg(F.count(F.lit(1)).alias("end1")).join(F.broadcast(beds[1].agg(F.count(F.lit(1)).alias("end2")))).join(F.broadcast(paired.agg(F.count(F.lit(1)).alias("paired"))))
    counts = classified.agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("type") == fragments.NORMAL).alias("normal")).join(F.broadcast(last.select(F.col("total").alias("final"))))
    sections = [
        qc.as_sections(flags, "trim", "flags"),
        qc.as_sections(qc.composition(paired, cfg.long_range), "contacts", "composition"),
        qc.as_sections(qc.type_counts(classified).groupBy().pivot("type", [fragments.NORMAL, fragments.SELF, fragments.RE]).agg(F.first("count")), "noise", "types"),
        qc.as_sections(counts.select(*qc.duplication(F.col("raw"), F.col("normal"), F.col("final"))), "noise", "duplication"),
        qc.as_sections(last, "pairs", "composition"),
    ]
    table = sections[0]
    for part in sections[1:]:
        table = table.unionByName(part)
    table = stage("qc", table)
    valid = trimmed.where(trim.is_valid()).count()
    spans = pairs.select(contacts.intra_span(pairs).alias("span"))
    tables = {
        "funnel": qc.read_funnel(flags, paired.agg(F.count(F.lit(1)).alias("mapped")), last),
        "alignment": qc.alignment_ratios(uniques, valid),
        "lengths": trim.length_distribution(trimmed).orderBy("pet", "length"),
        "scores": trim.score_distribution(trimmed).orderBy("part", F.desc("count"), "score"),
        "types": qc.type_counts(classified),
        "cells": qc.orientation_cells(classified),
        "long_short": qc.long_short(last),
        "spans": qc.log_log(qc.histogram(spans, "span", 1000)),
        "chromosomes": qc.chromosome_matrix(pairs),
    }
    return Run(trimmed, paired, classified, pairs, table, rounds, {name: stage(f"qc_{name}", df) for name, df in tables.items()})


def exact_aligner(genome: DataFrame, k: int, mapq: int = 60) -> Callable[[DataFrame, int], DataFrame]:
    """Reads of ``k`` bases or more by their first ``k`` bases, on either strand, and then in full: an equi-join with the k-mers of a small genome.

    A read that fits in one place is unique, in several it has quality 0, in none it is unmapped.
    """
    kmer = genome.select(F.col("name").alias("rname"), "seq", F.explode(F.sequence(F.lit(1), F.greatest(F.length("seq") - k + 1, F.lit(1)))).alias("at"))
    index = kmer.select("rname", "at", F.substr(F.col("seq"), F.col("at"), F.lit(k)).alias("seed"))
    whole = genome.select(F.col("name").alias("rname"), F.col("seq").alias("_whole"))

    def align(reads: DataFrame, _: int) -> DataFrame:
        both = reads.select("seqid", "seq", "quality", F.explode(F.array(F.struct(F.col("seq").alias("s"), F.lit(0).alias("f")), F.struct(reverse_complement(F.col("seq")).alias("s"), F.lit(16).alias("f")))).alias("x"))
        hits = both.withColumn("seed", F.left("x.s", F.lit(k))).join(index, "seed").join(whole, "rname").where(F.substr(F.col("_whole"), F.col("at"), F.length("x.s")) == F.col("x.s"))
        best = hits.groupBy("seqid").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rname", "at", "x.f")).alias("b"))
        out = reads.join(best, "seqid", "left")
        found = F.col("n").isNotNull()
        return out.select(
            F.col("seqid").alias("read_id"), F.when(found, F.col("b.f")).otherwise(4).alias("flag"), F.col("b.rname").alias("rname"), (F.col("b.at") - 1).cast("long").alias("pos"),
            (F.col("b.at") - 1 + F.length("seq")).cast("long").alias("end_pos"), F.when(F.col("n") == 1, mapq).otherwise(0).alias("mapq"), "seq", F.col("quality").alias("qual"),
        )

    return align
