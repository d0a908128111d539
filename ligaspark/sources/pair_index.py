"""Pairs laid out for rectangles: contacts near one another in both positions lie in one row group, so the statistics of a Parquet file tell which groups a query of two
regions has to read.

Rows are in the order of both chromosomes and of the Z-curve of both positions (Morton 1966), which takes their bits in turn. They are dealt out by range of that order,
rows of one place by a hash of all they hold, so neither a chromosome pair nor a place has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..genome import Region

GROUP_BYTES = 4 << 20  # of a row group


def _apart(x: Column) -> Column:
    """The low 31 bits of a number with a zero before each: halves are moved apart, then halves of halves."""
    x = x.cast("long").bitwiseAND(0x7FFFFFFF)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def z_value(a: Column, b: Column) -> Column:
    """Bits of both numbers in turn, of ``a`` first; numbers from 0 to 2^31 - 1, null where either is."""
    return F.shiftleft(_apart(a), 1).bitwiseOR(_apart(b))


def write_index(pairs: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Pairs (chr1, pos1, chr2, pos2 and whatever else) as Parquet in that order."""
    order = ["chr1", "chr2", "_z"]
    rows = pairs.withColumn("_z", z_value(F.col("pos1"), F.col("pos2")))
    dealt = rows.repartitionByRange(*order, F.xxhash64(*[F.col(f"`{c}`") for c in pairs.columns])).sortWithinPartitions(*order)
    dealt.drop("_z").write.option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", 5000).parquet(path)


def read_index(spark: SparkSession, path: str, region1: Region, region2: Region | None = None) -> DataFrame:
    """Pairs with one end in each region, either way round; of one region, with both ends in it. The condition reaches the scan, which leaves out groups and pages by it."""
    region2 = region2 or region1
    way = lambda a, b: a.holds(F.col("chr1"), F.col("pos1")) & b.holds(F.col("chr2"), F.col("pos2"))
    found = way(region1, region2) if region1 == region2 else way(region1, region2) | way(region2, region1)
    return spark.read.parquet(path).where(found)
