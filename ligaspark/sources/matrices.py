"""One reader for matrices of any format: :func:`open_matrix` gives an object with ``resolutions``, ``lengths`` and ``fetch``, by what kind of file a path is.

``BACKENDS`` has an opener, called with (spark, path), for each kind; :func:`register_backend` adds one, for formats whose libraries this package does without.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..genome import Region, choose_resolution
from . import hic
from .matrix_store import MatrixStore, file_kind


class Matrices(Protocol):
    """``fetch`` gives (i, j, count) of a rectangle, from the first bin of each region, both triangles where they overlap; without a resolution, by the length of the first."""

    @property
    def resolutions(self) -> list[int]: ...

    @property
    def lengths(self) -> dict[str, int]: ...

    def fetch(self, region1: Region, region2: Region | None = None, resolution: int | None = None, balance: bool = False, bins: int = 500) -> DataFrame: ...


class HicMatrices:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.header = hic.read_header(hic.HadoopFile(spark, path))

    @property
    def resolutions(self) -> list[int]:
        return sorted(self.header.resolutions)

    @property
    def lengths(self) -> dict[str, int]:
        return dict(self.header.chromosomes[1:])

    def fetch(self, region1: Region, region2: Region | None = None, resolution: int | None = None, balance: bool = False, bins: int = 500) -> DataFrame:
        region2 = region2 or region1
        start1, end1 = self._bounds(region1)
        start2, end2 = self._bounds(region2)
        width = resolution or choose_resolution(end1 - start1, self.resolutions, bins)
        (a1, z1), (a2, z2) = ((a // width, -(-z // width) - 1) for a, z in ((start1, end1), (start2, end2)))  # bins of each, the last included
        one, two = (Region(r.chrom, a * width, max(a, z) * width) for r, a, z in ((region1, a1, z1), (region2, a2, z2)))
        cells = hic.read_hic(self.spark, self.path, one, two, width=width, norm="KR" if balance else "NONE")
        x, y = (F.col(c) / F.lit(width) for c in "xy")
        cells = cells.select(x.cast("long").alias("i"), y.cast("long").alias("j"), "count")
        if region1.chrom == region2.chrom:
            there, back = F.struct("i", "j", "count"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "count")
            cells = cells.select(F.explode(F.when(F.col("i") == F.col("j"), F.array(there)).otherwise(F.array(there, back))).alias("c")).select("c.*")
        inside = F.col("i").between(a1, z1) & F.col("j").between(a2, z2)
        return cells.where(inside).select((F.col("i") - a1).alias("i"), (F.col("j") - a2).alias("j"), "count")

    def _bounds(self, region: Region) -> tuple[int, int]:
        length = self.lengths[region.chrom]
        return (0, length) if region.start is None else (region.start, min(region.end, length))


#: By kind of file, what opens it.
BACKENDS: dict[str, Callable[[SparkSession, str], Matrices]] = {"store": MatrixStore, "hic": HicMatrices}


def register_backend(kind: str, opener: Callable[[SparkSession, str], Matrices]) -> None:
    BACKENDS[kind] = opener


def open_matrix(spark: SparkSession, path: str) -> Matrices:
    kind = file_kind(path)
    if kind not in BACKENDS:
        raise ValueError(f"no reader of {kind} files is registered: {path}")
    return BACKENDS[kind](spark, path)
