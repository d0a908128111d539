"""Contacts: canonical orientation, conversions between record kinds, predicates and sorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..genome import Region, natural_key, with_chr
from ..schema import BEDPE_KEY, PAIRS_KEY


def is_bedpe(df: DataFrame) -> bool:
    return "start1" in df.columns


def upper_triangle(df: DataFrame) -> DataFrame:
    """The lesser end first, by name of the chromosome as a string and then by start or position. Tags, name and score stay where they are."""
    fields = ("chr", "start", "end", "strand") if is_bedpe(df) else ("chr", "pos", "strand")
    at = fields[1]
    swap = (F.col("chr1") > F.col("chr2")) | ((F.col("chr1") == F.col("chr2")) & (F.col(f"{at}1") > F.col(f"{at}2")))
    flip = {f"{f}{a}": F.when(swap, F.col(f"{f}{b}")).otherwise(F.col(f"{f}{a}")) for f in fields for a, b in ((1, 2), (2, 1))}
    return df.withColumns(flip)


def to_pairs(bedpe: DataFrame, end1: str = "start", end2: str = "start") -> DataFrame:
    """Pairs of canonical BEDPE; ``end1`` and ``end2`` say which bound of each end is its position."""
    up = upper_triangle(bedpe)
    return up.select("name", "chr1", F.col(f"{end1}1").alias("pos1"), "chr2", F.col(f"{end2}2").alias("pos2"), "strand1", "strand2")


def to_short(bedpe: DataFrame) -> DataFrame:
    """Midpoints of both ends, chromosome names with their prefix."""
    mid = lambda k: F.floor((F.col(f"start{k}") + F.col(f"end{k}")) / 2)
    return bedpe.select(with_chr(F.col("chr1")).alias("chr_a"), mid(1).alias("pos_a"), with_chr(F.col("chr2")).alias("chr_b"), mid(2).alias("pos_b"), "score")


def is_inter() -> Column:
    return F.col("chr1") != F.col("chr2")


def span(df: DataFrame) -> Column:
    """Distance between the ends: from end to start in BEDPE, between positions in pairs."""
    return F.abs(F.col("start2") - F.col("end1")) if is_bedpe(df) else F.abs(F.col("pos2") - F.col("pos1"))


def intra_span(df: DataFrame) -> Column:
    """Distance between starts or positions, null across chromosomes."""
    a, b = ("start1", "start2") if is_bedpe(df) else ("pos1", "pos2")
    return F.when(F.col("chr1") == F.col("chr2"), F.abs(F.col(b) - F.col(a)))


def sort_contacts(df: DataFrame, *ties: str) -> DataFrame:
    """All rows by the key of their kind, and then by the columns ``ties``; dealt out by ranges of the key, so no task has more than its range."""
    return df.orderBy(*(BEDPE_KEY if is_bedpe(df) else PAIRS_KEY), *ties)


def sort_by_first(df: DataFrame, *ties: str) -> DataFrame:
    """Contacts by their first end: chromosomes in version order, then start and end, and then the columns ``ties``.

    A chromosome's rank and the start make one number, the first key of the sort, so that its prefix tells most rows apart; a null start comes first."""
    rank = (F.row_number().over(Window.orderBy(*natural_key(F.col("chr1"))))).cast("long")  # a row per chromosome
    ranks = df.select("chr1").where("chr1 is not null").distinct().withColumn("_k", rank)
    place = F.col("_k") * (1 << 40) + F.coalesce("start1", F.lit(-(1 << 39)))
    return df.join(F.broadcast(ranks), "chr1", "left").orderBy(place, "start1", "end1", *ties).select(*df.columns)


def merge_sorted(*runs: DataFrame) -> DataFrame:
    """Sorted tables of contacts as one, sorted. Spark deals the rows out by ranges of the key and sorts each range, which costs what a merge of many runs would."""
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return sort_contacts(out)


def sort_bed(df: DataFrame) -> DataFrame:
    return df.orderBy(*natural_key(F.col("chr")), "start", "end")


def on_chromosomes(df: DataFrame, chroms: DataFrame) -> DataFrame:
    """Contacts with both ends on the listed chromosomes. The list is small, so it goes to the contacts, of which few chromosomes would make few tasks."""
    for k in (1, 2):
        df = df.join(F.broadcast(chroms.select(F.col("chrom").alias(f"chr{k}")).distinct()), f"chr{k}", "left_semi")
    return df


def in_region(bed: DataFrame, region: Region) -> DataFrame:
    return bed.where(region.overlaps(F.col("chr"), F.col("start"), F.col("end")))


def chromosome_pairs(df: DataFrame) -> DataFrame:
    return df.select("chr1", "chr2").distinct()


def without_marks(lines: DataFrame, anywhere: bool = False) -> DataFrame:
    """Text lines that are no comments; ``anywhere`` drops every line that holds a mark."""
    return lines.where(~F.col("value").contains("#")) if anywhere else lines.where(~F.rlike("value", F.lit("^[ \\t]*#")))
