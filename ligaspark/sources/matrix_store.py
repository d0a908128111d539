"""Multi-resolution matrices as Parquet: ``chroms``, ``bins`` and ``pixels`` below one folder, the latter two partitioned by resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..genome import Region, choose_resolution
from ..operators import matrix
from ..session import discard


def write_store(pixels: DataFrame, sizes: DataFrame, base: int, resolutions: list[int], path: str, balanced: bool = False) -> None:
    """Pixels of the base width at all resolutions, with weights where balancing is asked for and converges. Each resolution is computed from the coarsest one
    before it that divides it, as it has been written."""
    sizes.write.parquet(f"{path}/chroms")
    made: dict[int, DataFrame] = {}
    for r in sorted(set(resolutions) | {base}):
        source = max((m for m in made if r % m == 0), default=None)
        part = pixels if source is None else matrix.coarsen(made[source], sizes, source, r)
        here = f"{path}/pixels/resolution={r}"
        part.repartitionByRange("bin1_id").sortWithinPartitions("bin1_id", "bin2_id").write.parquet(here)
        made[r] = pixels.sparkSession.read.parquet(here)
        bins = matrix.make_bins(sizes, r)
        weights = matrix.balance(made[r]) if balanced else None
        bins = bins.join(weights, "bin_id", "left") if weights is not None else bins.withColumn("weight", F.lit(None).cast("double"))
        bins.write.parquet(f"{path}/bins/resolution={r}")
        if weights is not None:
            discard(weights)


def file_kind(path: str) -> str:
    """"hic", "mcool" or "cool" by the suffix, "store" for a folder of this module's; ValueError for anything else."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    for suffix, kind in ((".hic", "hic"), (".mcool", "mcool"), (".cool", "cool")):
        if name.endswith(suffix):
            return kind
    if "." not in name or name.endswith((".matrix", ".store")):
        return "store"
    raise ValueError(f"no matrix file: {path}")


class MatrixStore:
    """Reads what :func:`write_store` wrote; resolutions and bins are pruned by folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.chroms = spark.read.parquet(f"{path}/chroms")

    @property
    def resolutions(self) -> list[int]:
        rows = self.spark.read.parquet(f"{self.path}/bins").select("resolution").distinct().collect()
        return sorted(r["resolution"] for r in rows)

    @property
    def is_multi(self) -> bool:
        """Whether there is more than one resolution."""
        return len(self.resolutions) > 1

    @property
    def lengths(self) -> dict[str, int]:
        return {r["chrom"]: r["length"] for r in self.chroms.orderBy("ord").collect()}

    def bins(self, resolution: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/bins").where(F.col("resolution") == resolution).drop("resolution")

    def pixels(self, resolution: int, balance: bool = False) -> DataFrame:
        px = self.spark.read.parquet(f"{self.path}/pixels").where(F.col("resolution") == resolution).drop("resolution")
        if not balance:
            return px
        weights = self.bins(resolution).select("bin_id", "weight").where("weight is not null")
        if not weights.take(1):  # never balanced: counts as they are
            return px
        return matrix.apply_weights(px, weights).select("bin1_id", "bin2_id", F.col("balanced").alias("count"))

    def fetch(self, region1: Region, region2: Region | None = None, resolution: int | None = None, balance: bool = False, bins: int = 500) -> DataFrame:
        """(i, j, count) of a rectangle; without a resolution the coarsest that still gives ``bins`` bins."""
        if resolution is None:
            length = (region1.end - region1.start) if region1.start is not None else self.lengths[region1.chrom]
            resolution = choose_resolution(length, self.resolutions, bins)
        return matrix.fetch(self.pixels(resolution, balance), self.bins(resolution), region1, region2)

    def fetch_all(self, bins: int = 2000, balance: bool = False) -> DataFrame:
        r = choose_resolution(sum(self.lengths.values()), self.resolutions, bins)
        return matrix.whole_genome(self.pixels(r, balance))
