"""Restriction sites of sequences that come in pieces, so that a chromosome is many tasks.

Occurrences inside a piece are found in it; those that go on into the next pieces are found in the last letters of a piece and the first ones of those that follow,
which are all that is moved. A site that can overlap itself needs one more step for the rule that occurrences are taken from left to right without
overlap: runs of occurrences that overlap one another are told apart by the distance to the one before, and each run is gone through in order. The result is
that of a scan of whole sequences (``fragments.scan_sites``), whatever the pieces' lengths.

Pieces are (file, record, name, start, seq), as ``fastx_source.read_pieces`` gives them. Letters count in either case, empty pieces are skipped, a record without
letters has the bounds 0 and 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import all_starts, reverse_complement_text
from ..genome import Site

_RECORD = ["file", "record", "name"]


def occurrences(pieces: DataFrame, pattern: str) -> DataFrame:
    """(file, record, name, pos): every occurrence, overlapping ones too."""
    n = len(pattern)
    own = pieces.where("seq <> ''").select(*_RECORD, F.col("start").cast("long").alias("start"), F.upper("seq").alias("seq"))
    inside = own.select(*_RECORD, "start", F.explode(all_starts(F.col("seq"), pattern)).alias("p")).select(*_RECORD, (F.col("start") + F.col("p")).alias("pos"))
    if n == 1:
        return inside
    ends = own.select(*_RECORD, "start", F.length("seq").alias("n"), F.right("seq", F.lit(n - 1)).alias("tail"), F.left("seq", F.lit(n - 1)).alias("head"))
    ahead = Window.partitionBy(*_RECORD).orderBy("start").rowsBetween(1, n - 1)
    ends = ends.withColumn("both", F.concat("tail", F.left(F.array_join(F.collect_list("head").over(ahead), ""), F.lit(n - 1))))
    across = ends.select(*_RECORD, (F.col("start") + F.col("n") - F.length("tail")).alias("at"), F.explode(all_starts(F.col("both"), pattern)).alias("p"), F.length("tail").alias("m"))
    return inside.union(across.where("p < m").select(*_RECORD, (F.col("at") + F.col("p")).alias("pos")))


def without_overlap(found: DataFrame, n: int) -> DataFrame:
    """Occurrences of a pattern of ``n`` letters from left to right, those that overlap one that is taken left out. A run of occurrences that overlap is one array."""
    w = Window.partitionBy(*_RECORD).orderBy("pos")
    begins = F.coalesce(F.col("pos") - F.lag("pos").over(w) >= n, F.lit(True)).cast("long")
    runs = found.withColumn("_b", begins).withColumn("_run", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*_RECORD, "_run").agg(F.sort_array(F.collect_list("pos")).alias("_p"))
    start = F.struct(F.lit(-n).cast("long").alias("last"), F.array().cast("array<bigint>").alias("out"))
    take = lambda acc, p: F.when(p - acc["last"] >= n, F.struct(p.alias("last"), F.concat(acc["out"], F.array(p)).alias("out"))).otherwise(acc)
    return runs.select(*_RECORD, F.explode(F.aggregate("_p", start, take, lambda acc: acc["out"])).alias("pos"))


def overlaps_itself(pattern: str) -> bool:
    return any(pattern[k:] == pattern[:-k] for k in range(1, len(pattern)))


def scan_pieces(pieces: DataFrame, site: Site) -> DataFrame:
    """(chrom, strand, pos): cut positions, with the bounds 0 and length on ``+``; a second scan on ``-`` if the site is no palindrome."""

    def cuts(pattern: str, strand: str) -> DataFrame:
        found = occurrences(pieces, pattern)
        found = without_overlap(found, len(pattern)) if overlaps_itself(pattern) else found
        return found.select(F.col("name").alias("chrom"), F.lit(strand).alias("strand"), (F.col("pos") + site.cut).alias("pos"))

    lengths = pieces.groupBy(*_RECORD).agg(F.sum(F.length("seq")).cast("long").alias("n"))
    bounds = lengths.select(F.col("name").alias("chrom"), F.lit("+").alias("strand"), F.explode(F.array(F.lit(0).cast("long"), "n")).alias("pos"))
    out = cuts(site.seq.upper(), "+").union(bounds)
    other = reverse_complement_text(site.seq).upper()
    return (out if other == site.seq.upper() else out.union(cuts(other, "-"))).distinct()
