"""Expected counts by distance within chromosomes, and counts over them (Lieberman-Aiden et al. 2009)."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from . import matrix

ENOUGH = 400  # contacts that a window of distances has to hold


class Expected(NamedTuple):
    """``values``: expected count of a cell by its distance in bins, over all chromosomes; ``factors``: by chromosome, what values are divided by to hold for it."""

    values: np.ndarray
    factors: dict[str, float]


def within_chromosomes(pixels: DataFrame, sizes: DataFrame, binsize: int) -> DataFrame:
    """Pixels whose bins are of one chromosome, with ``chrom`` and ``distance`` in bins. A chromosome's bins are a run, so its last one decides."""
    last = matrix.genome_offsets(sizes, binsize).select("chrom", (F.col("offset") + F.col("n_bins") - 1).alias("_last"))
    bins = matrix.make_bins(sizes, binsize).select("bin_id", "chrom").join(last, "chrom")
    own = pixels.join(bins.withColumnRenamed("bin_id", "bin1_id"), "bin1_id").where(F.col("bin2_id") <= F.col("_last"))
    return own.select("bin1_id", "bin2_id", "count", "chrom", (F.col("bin2_id") - F.col("bin1_id")).alias("distance"))


def expected(pixels: DataFrame, sizes: DataFrame, binsize: int, enough: float = ENOUGH) -> Expected:
    """Counts at a distance over the cells that all chromosomes have there. A distance with fewer than ``enough`` counts takes those around it, as many on both sides as it
    needs, or all. A chromosome's factor is what the values give for all its cells over what it has; 1 where it has nothing.

    Sums by chromosome and distance are made by Spark; the driver gets a number for each distance and each chromosome, as many as the longest chromosome has bins.
    """
    sums = written(within_chromosomes(pixels, sizes, binsize).groupBy("chrom", "distance").agg(F.sum("count").cast("double").alias("n")))
    bins = {r["chrom"]: r["n_bins"] for r in matrix.genome_offsets(sizes, binsize).collect()}  # a row for each chromosome
    seen = {r["chrom"]: r["n"] for r in sums.groupBy("chrom").agg(F.sum("n").alias("n")).collect()}
    n = max(bins.values(), default=0)
    if not n:
        discard(sums)
        return Expected(np.zeros(0), dict.fromkeys(bins, 1.0))
    observed = np.zeros(n)
    for r in sums.groupBy("distance").agg(F.sum("n").alias("n")).toLocalIterator():
        observed[r["distance"]] = r["n"]
    discard(sums)
    longer = len(bins) - np.cumsum(np.bincount(list(bins.values()), minlength=n + 1))[:n]  # chromosomes of more bins than a distance
    cells = np.cumsum(longer[::-1])[::-1]
    upto, cells_upto = (np.concatenate([[0], np.cumsum(a)]) for a in (observed, cells))
    at = np.arange(n)
    low, high = np.zeros(n, np.int64), np.full(n, n, np.int64)
    while (low < high).any():  # the narrowest window with enough, of all distances at once
        mid = (low + high) // 2
        full = upto[np.minimum(at + mid + 1, n)] - upto[np.maximum(at - mid, 0)] >= enough
        low, high = np.where(full | (low >= high), low, mid + 1), np.where(full, mid, high)
    a, z = np.maximum(at - low, 0), np.minimum(at + low + 1, n)
    values = (upto[z] - upto[a]) / (cells_upto[z] - cells_upto[a])
    total, moments = (np.concatenate([[0], np.cumsum(v)]) for v in (values, values * at))
    return Expected(values, {c: float((k * total[k] - moments[k]) / seen[c]) if seen.get(c) else 1.0 for c, k in bins.items()})


def over_expected(pixels: DataFrame, sizes: DataFrame, binsize: int, found: Expected | None = None) -> DataFrame:
    """(bin1_id, bin2_id, count, oe) of the cells within chromosomes: counts over what is expected at their distance; null where nothing is."""
    spark = pixels.sparkSession
    found = found or expected(pixels, sizes, binsize)
    values = spark.createDataFrame([(k, float(v)) for k, v in enumerate(found.values)], "distance long, _e double")
    factors = spark.createDataFrame(list(found.factors.items()), "chrom string, _f double")
    rows = within_chromosomes(pixels, sizes, binsize).join(values, "distance").join(F.broadcast(factors), "chrom")
    return rows.select("bin1_id", "bin2_id", "count", F.try_divide(F.col("count") * F.col("_f"), F.col("_e")).alias("oe"))
