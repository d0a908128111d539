"""Quality-control statistics, each as a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contacts import is_inter, span, upper_triangle

PERCENTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; 0 when there is no whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.when(whole != 0, whole).cast("double"))


def composition(df: DataFrame, cutoff: int = 20_000) -> DataFrame:
    """One row: total, inter, intra, long_range (intra, and ``cutoff`` apart or more)."""
    far = ~is_inter() & (span(df) >= cutoff)
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(is_inter()).alias("inter"), F.count_if(~is_inter()).alias("intra"), F.count_if(far).alias("long_range"))


def long_short(comp: DataFrame) -> DataFrame:
    """(part, count, share) with the intra-chromosomal contacts split by distance."""
    parts = {"inter": F.col("inter"), "intra_long": F.col("long_range"), "intra_short": F.col("intra") - F.col("long_range")}
    rows = comp.select("total", F.explode(F.array(*[F.struct(F.lit(k).alias("part"), v.alias("count")) for k, v in parts.items()])).alias("x"))
    return rows.select("x.part", "x.count", ratio(F.col("x.count"), F.col("total")).alias("share"))


def type_counts(classified: DataFrame) -> DataFrame:
    """(type, count, share) over classes."""
    counts = classified.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("type", "count", ratio(F.col("count"), F.col("total")).alias("share"))


def orientation_cells(classified: DataFrame) -> DataFrame:
    """(strand1, strand2, side1, side2, count): all 16 cells, those without contacts as 0; contacts without fragments are not counted."""
    key = ["strand1", "strand2", "side1", "side2"]
    pair = lambda a, b, name: F.explode(F.array(F.lit(a), F.lit(b))).alias(name)
    cells = classified.sparkSession.range(1).select(pair("+", "-", key[0])).select("*", pair("+", "-", key[1])).select("*", pair("s", "t", key[2])).select("*", pair("s", "t", key[3]))
    counts = classified.where(F.col("side1").isNotNull() & F.col("side2").isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    return cells.join(counts, key, "left").select(*key, F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def site_distances(classified: DataFrame) -> DataFrame:
    """(end, dis, count): signed distances to the nearest site, all partitions summed."""
    long = classified.select(F.explode(F.array(*[F.struct(F.lit(k).alias("end"), F.col(f"dis{k}").alias("dis")) for k in (1, 2)])).alias("x")).where("x.dis is not null")
    return long.groupBy(F.col("x.end").alias("end"), F.col("x.dis").alias("dis")).agg(F.count(F.lit(1)).alias("count"))


def chromosome_matrix(df: DataFrame) -> DataFrame:
    """(chr1, chr2, count) over all ordered pairs of the chromosomes that occur, symmetric, zero-filled; contacts in either order are summed."""
    counts = upper_triangle(df).groupBy("chr1", "chr2").agg(F.count(F.lit(1)).alias("count"))
    way = lambda a, b: F.struct(F.col(a).alias("chr1"), F.col(b).alias("chr2"), F.col("count"))
    ways = F.when(F.col("chr1") == F.col("chr2"), F.array(way("chr1", "chr2"))).otherwise(F.array(way("chr1", "chr2"), way("chr2", "chr1")))
    both = counts.select(F.explode(ways).alias("x")).select("x.*")  # one branch, so that the grouped counts are made once and reused
    names = both.select("chr1").distinct().agg(F.sort_array(F.collect_list("chr1")).alias("n"))  # chromosomes: a bounded list
    grid = names.select(F.explode("n").alias("chr1"), "n").select("chr1", F.explode("n").alias("chr2"))
    return grid.join(both, ["chr1", "chr2"], "left").select("chr1", "chr2", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def pivoted(matrix: DataFrame, chroms: list[str]) -> DataFrame:
    """One row per chromosome ``chrom`` and a column per chromosome."""
    return matrix.groupBy(F.col("chr1").alias("chrom")).pivot("chr2", chroms).agg(F.first("count")).na.fill(0).orderBy("chrom")


def upper_long(wide: DataFrame, chroms: list[str]) -> DataFrame:
    """The other way: a wide matrix to (chr1, chr2, count) with chr2 not before chr1 in the list."""
    long = wide.unpivot(["chrom"], chroms, "chr2", "count").withColumnRenamed("chrom", "chr1")
    order = F.array(*[F.lit(c) for c in chroms])
    return long.where(F.array_position(order, F.col("chr2")) >= F.array_position(order, F.col("chr1")))


def quantiles(df: DataFrame, value: str, shares: dict[str, float], *by: str) -> DataFrame:
    """A row per group with the exact linear quantiles; nulls do not count.

    Values are counted first, which combines before the shuffle. Ranks are running sums in two steps, within buckets of values and over bucket totals; then only the
    rows at the two ranks around each quantile are left. Buckets are even in the logarithm of the distance from the least value and from the greatest, so
    values far more crowded than the range between them, as those of spans are, or far outliers at either end, still fall into many.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    ends = rows.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_k").alias("_n"))
    same = lambda a, b: a.join(F.broadcast(b)) if not by else a.join(b, list(by))
    spread = F.col("_hi") - F.col("_lo")
    depth = lambda far: F.floor(F.log1p(far / F.when(spread != 0, spread) * 2.0**40) * 64)  # noqa: E731 - rises with ``far``, so their difference rises with the value
    bucket = depth(F.col("_v") - F.col("_lo")) - depth(F.col("_hi") - F.col("_v"))
    rows = same(rows, ends).withColumn("_b", F.when(spread == 0, F.lit(0)).otherwise(bucket).cast("int"))
    group = [*by] or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over one row per bucket
    totals = rows.groupBy(*by, "_b").agg(F.sum("_k").alias("_t")).withColumn("_base", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    up = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.join(totals, [*by, "_b"]).withColumn("_z", F.col("_base") + F.sum("_k").over(up)).withColumn("_a", F.col("_z") - F.col("_k"))
    out = []
    for name, p in shares.items():
        at = (F.col("_n") - 1) * F.lit(p)
        low, high = F.floor(at), F.ceil(at)
        pick = lambda r: F.max(F.when((F.col("_a") <= r) & (r < F.col("_z")), F.col("_v")))  # noqa: B023, E731
        out += [pick(low).alias(f"_l_{name}"), pick(high).alias(f"_h_{name}")]
    got = ranked.groupBy(*by).agg(F.max("_n").alias("_n"), *out)
    part = lambda p: (F.col("_n") - 1) * F.lit(p) - F.floor((F.col("_n") - 1) * F.lit(p))
    return got.select(*by, *[(F.col(f"_l_{n}") + part(p) * (F.col(f"_h_{n}") - F.col(f"_l_{n}"))).alias(n) for n, p in shares.items()])


def describe(df: DataFrame, value: str, *by: str) -> DataFrame:
    """count, mean, sample deviation, minimum, exact linear quartiles, maximum; nulls do not count."""
    v = F.col(value)
    stats = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
    plain = df.groupBy(*by).agg(*stats) if by else df.agg(*stats)
    ranks = quantiles(df, value, PERCENTS, *by)
    both = plain.join(F.broadcast(ranks), F.lit(True), "left") if not by else plain.join(ranks, list(by), "left")
    return both.select(*by, "count", "mean", "std", "min", *PERCENTS, "max")


def histogram(df: DataFrame, value: str, bins: int = 1000) -> DataFrame:
    """(bin, start, end, count): equal widths from the smallest to the largest value, the last bin closed, empty ones included."""
    v = F.col(value).cast("double")
    ends = df.where(v.isNotNull()).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))  # one row
    spread = F.col("hi") - F.col("lo")
    at = F.when(spread == 0, F.lit(0)).otherwise(F.least(F.floor((v - F.col("lo")) * bins / F.when(spread != 0, spread)), F.lit(bins - 1)))
    counts = df.where(v.isNotNull()).join(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = ends.where("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edge = lambda k: F.col("lo") + spread * k / bins
    return grid.join(counts, "bin", "left").select("bin", edge(F.col("bin")).alias("start"), edge(F.col("bin") + 1).alias("end"), F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def log_log(hist: DataFrame) -> DataFrame:
    """(bin, x, y): decimal logarithms of bin midpoints and counts, empty bins and midpoints of 0 or less left out."""
    mid = (F.col("start") + F.col("end")) / 2
    return hist.where((F.col("count") > 0) & (mid > 0)).select("bin", F.log10(mid).alias("x"), F.log10("count").alias("y"))


def quantile_trim(df: DataFrame, value: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Rows strictly between two exact quantiles."""
    ends = quantiles(df, value, {"_a": low, "_z": high})  # one row
    return df.join(F.broadcast(ends)).where((F.col(value) > F.col("_a")) & (F.col(value) < F.col("_z"))).drop("_a", "_z")


def alignment_ratios(uniques: DataFrame, valid: int) -> DataFrame:
    """(end, count, ratio): unique alignments of each end, and pairs, over the valid tag pairs. ``uniques``: one row with end1, end2, paired."""
    return funnel(uniques.withColumn("valid", F.lit(valid)), ["end1", "end2", "paired"], "valid").select(F.col("step").alias("end"), "count", "ratio")


def read_funnel(flags: DataFrame, mapped: DataFrame, final: DataFrame) -> DataFrame:
    """(ord, step, count, ratio to raw reads) of a whole run, nine steps; reads across linkers are null where linkers can't tell. Each input is one row:
    counters of trimming, ``mapped`` (unique pairs), and the composition of the last contacts."""
    one = flags.select(F.col("total").alias("raw"), (F.col("total") - F.col("unlinked")).alias("linker"), F.col("intra").alias("same_linker"), F.when(F.col("inter") > 0, F.col("inter")).alias("across_linkers"), F.col("valid"))
    last = final.select(F.col("total").alias("non_redundant"), "inter", "intra")
    one = one.join(F.broadcast(mapped)).join(F.broadcast(last))
    return funnel(one, ["raw", "linker", "same_linker", "across_linkers", "valid", "mapped", "non_redundant", "inter", "intra"], "raw")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The rows for which a condition holds, and the others (unknown included)."""
    yes = F.coalesce(condition, F.lit(False))
    return df.where(yes), df.where(~yes)


def duplication(raw: Column, normal: Column, final: Column) -> list[Column]:
    return [(normal - final).alias("duplicated"), ratio(normal - final, raw).alias("of_raw"), ratio(normal - final, normal).alias("of_normal")]


def funnel(counts: DataFrame, steps: list[str], whole: str) -> DataFrame:
    """(ord, step, count, ratio): a one-row table of counts as steps, each over the count ``whole``."""
    rows = counts.select(F.col(whole).alias("_w"), F.posexplode(F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("count")) for s in steps])).alias("ord", "x"))
    return rows.select("ord", "x.step", "x.count", ratio(F.col("x.count"), F.col("_w")).alias("ratio"))


def value_range(df: DataFrame, value: str, eps: float = 1e-4) -> DataFrame:
    """One row for a colour scale: the smallest value above the minimum and the maximum, NaN apart; a single value is widened by ``eps``."""
    v = F.col(value).cast("double")
    ok = df.where(v.isNotNull() & ~F.isnan(v))
    low = ok.agg(F.min(v).alias("_m"), F.max(v).alias("hi"))
    out = ok.join(F.broadcast(low)).agg(F.min(F.when(v > F.col("_m"), v)).alias("lo"), F.max("hi").alias("hi"))
    return out.select(F.coalesce("lo", F.col("hi") - eps).alias("lo"), "hi")


def stage_durations(log: DataFrame) -> DataFrame:
    """(stage, start, end, seconds) from log lines that end in ``@ 11/26/26 22:43:00: START: stage`` or ``END``."""
    pattern = r"@ (\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}): (START|END): (.*)$"
    at, what, stage = (F.regexp_extract(F.rtrim(F.col("value")), pattern, k) for k in (1, 2, 3))
    rows = log.where(F.rlike(F.rtrim(F.col("value")), F.lit(pattern))).select(what.alias("what"), stage.alias("stage"), F.try_to_timestamp(at, F.lit("MM/dd/yy HH:mm:ss")).alias("at"))
    out = rows.groupBy("stage").agg(F.max(F.when(F.col("what") == "START", F.col("at"))).alias("start"), F.max(F.when(F.col("what") == "END", F.col("at"))).alias("end"))
    return out.withColumn("seconds", F.unix_timestamp("end") - F.unix_timestamp("start"))


def as_sections(df: DataFrame, step: str, section: str) -> DataFrame:
    """A one-row table as rows of the long QC table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns])
    rows = df.limit(1).select(F.posexplode(pairs).alias("ord", "x"))
    return rows.select(F.lit(step).alias("step"), F.lit(section).alias("section"), "ord", "x.key", "x.value")
