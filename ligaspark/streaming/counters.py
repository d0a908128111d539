"""QC counters over contact files as they arrive, and de-duplication of a stream of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contacts import is_inter, span, upper_triangle
from ..schema import PAIRS, PAIRS_KEY
from ..sources.text import parse


def stream_pairs(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Pairs from text files that are dropped into a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return parse(lines.where(~F.rlike("value", F.lit("^[ \\t]*#"))), PAIRS)


def running_composition(pairs: DataFrame, cutoff: int = 20_000) -> DataFrame:
    """Totals so far, for output mode ``complete``."""
    far = ~is_inter() & (span(pairs) >= cutoff)
    return pairs.groupBy().agg(F.count(F.lit(1)).alias("total"), F.count_if(is_inter()).alias("inter"), F.count_if(~is_inter()).alias("intra"), F.count_if(far).alias("long_range"))


def running_chromosome_counts(pairs: DataFrame) -> DataFrame:
    return upper_triangle(pairs).groupBy("chr1", "chr2").agg(F.count(F.lit(1)).alias("count"))


def unique_pairs(pairs: DataFrame, arrived: str, delay: str = "1 hour") -> DataFrame:
    """First of equal pairs within a watermark on the time column ``arrived``; state is dropped once it has passed."""
    return upper_triangle(pairs).withWatermark(arrived, delay).dropDuplicatesWithinWatermark(list(PAIRS_KEY))
