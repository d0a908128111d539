"""Contact matrices: bins, pixels, resolutions, regions and normalization.

A pixel is (bin1_id, bin2_id, count) with bin1_id at most bin2_id, by the order of chromosomes and then positions. Finding a position's bin is arithmetic on the
chromosome's offset, so no range join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..genome import Region
from ..session import discard, written
from .contacts import is_bedpe


def genome_offsets(sizes: DataFrame, binsize: int) -> DataFrame:
    """(chrom, length, ord, n_bins, offset): bins of each chromosome and how many come before it."""
    n = F.ceil(F.col("length") / binsize).cast("long")
    w = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # one row per chromosome
    return sizes.withColumn("n_bins", n).withColumn("offset", F.coalesce(F.sum("n_bins").over(w), F.lit(0)))


def make_bins(sizes: DataFrame, binsize: int) -> DataFrame:
    """(bin_id, chrom, start, end): fixed widths, each chromosome's last bin short."""
    rows = genome_offsets(sizes, binsize).where("n_bins > 0").select("chrom", "length", "offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bins") - 1)).alias("k"))
    return rows.select((F.col("offset") + F.col("k")).alias("bin_id"), "chrom", (F.col("k") * binsize).alias("start"), F.least((F.col("k") + 1) * binsize, F.col("length")).alias("end"))


def bin_contacts(df: DataFrame, sizes: DataFrame, binsize: int) -> DataFrame:
    """Pixels of contacts whose ends lie within known chromosomes; BEDPE ends count by their start."""
    at = ("start1", "start2") if is_bedpe(df) else ("pos1", "pos2")
    offsets = genome_offsets(sizes, binsize)
    for k in (1, 2):
        here = offsets.select(F.col("chrom").alias(f"chr{k}"), F.col("length").alias(f"_l{k}"), F.col("offset").alias(f"_o{k}"))
        df = df.join(here, f"chr{k}").where((F.col(at[k - 1]) >= 0) & (F.col(at[k - 1]) < F.col(f"_l{k}")))
    a, b = (F.col(f"_o{k}") + F.floor(F.col(at[k - 1]) / binsize) for k in (1, 2))
    return df.select(F.least(a, b).alias("bin1_id"), F.greatest(a, b).alias("bin2_id")).groupBy("bin1_id", "bin2_id").agg(F.count(F.lit(1)).alias("count"))


def coarsen(pixels: DataFrame, sizes: DataFrame, base: int, to: int) -> DataFrame:
    """Pixels at a multiple of the base width, from the base's pixels rather than from contacts."""
    if to % base:
        raise ValueError(f"{to} is no multiple of {base}")
    bins = make_bins(sizes, base).join(genome_offsets(sizes, to).select("chrom", "offset"), "chrom")
    new = bins.select("bin_id", (F.col("offset") + F.floor(F.col("start") / to)).alias("to_id"))
    for k in (1, 2):
        pixels = pixels.join(new.select(F.col("bin_id").alias(f"bin{k}_id"), F.col("to_id").alias(f"_t{k}")), f"bin{k}_id")
    a, b = F.col("_t1"), F.col("_t2")
    return pixels.select(F.least(a, b).alias("bin1_id"), F.greatest(a, b).alias("bin2_id"), "count").groupBy("bin1_id", "bin2_id").agg(F.sum("count").alias("count"))


def zoom(pixels: DataFrame, sizes: DataFrame, base: int, resolutions: list[int]) -> DataFrame:
    """(resolution, bin1_id, bin2_id, count) at all resolutions; each comes from the coarsest one made before that divides it."""
    made = {base: pixels}
    for r in sorted(set(resolutions) - {base}):
        source = max(m for m in made if r % m == 0)
        made[r] = coarsen(made[source], sizes, source, r)
    out = None
    for r in sorted(set(resolutions)):
        part = made[r].select(F.lit(r).cast("long").alias("resolution"), "bin1_id", "bin2_id", "count")
        out = part if out is None else out.unionByName(part)
    return out


def mirrored(pixels: DataFrame) -> DataFrame:
    """Both triangles of a symmetric matrix, the diagonal once, from one pass over the pixels."""
    way = lambda a, b: F.struct(F.col(a).alias("bin1_id"), F.col(b).alias("bin2_id"), F.col("count"))
    up, down = way("bin1_id", "bin2_id"), way("bin2_id", "bin1_id")
    ways = F.when(F.col("bin1_id") == F.col("bin2_id"), F.array(up)).otherwise(F.array(up, down))
    return pixels.select(F.explode(ways).alias("x")).select("x.*")


def fetch(pixels: DataFrame, bins: DataFrame, region1: Region, region2: Region | None = None) -> DataFrame:
    """(i, j, count): cells of a rectangle, from the first bin of each region; mirrored when both regions are the same.

    A region is a run of bins, so its bounds are two numbers; they filter the pixels in the scan, in both triangles, before anything is mirrored.
    """
    region2 = region2 or region1
    ends = bins.agg(*[f(F.when(_in(r), F.col("bin_id"))).alias(n) for r, k in ((region1, 1), (region2, 2)) for f, n in ((F.min, f"a{k}"), (F.max, f"z{k}"))]).first()  # one row
    if ends["a1"] is None or ends["a2"] is None:
        return pixels.select(F.col("bin1_id").alias("i"), F.col("bin2_id").alias("j"), "count").limit(0)
    one = lambda c: F.col(c).between(ends["a1"], ends["z1"])
    two = lambda c: F.col(c).between(ends["a2"], ends["z2"])
    near = pixels.where((one("bin1_id") & two("bin2_id")) | (two("bin1_id") & one("bin2_id")))
    cells = mirrored(near).where(one("bin1_id") & two("bin2_id"))
    return cells.select((F.col("bin1_id") - ends["a1"]).alias("i"), (F.col("bin2_id") - ends["a2"]).alias("j"), "count")


def _in(region: Region):
    here = F.col("chrom") == region.chrom
    return here if region.start is None else here & (F.col("end") > region.start) & (F.col("start") < region.end)


def whole_genome(pixels: DataFrame) -> DataFrame:
    """(i, j, count) of the full square matrix; bin numbers are already offset by chromosome."""
    return mirrored(pixels).toDF("i", "j", "count")


def marginals(pixels: DataFrame, value: str = "count") -> DataFrame:
    """(bin_id, total): row sums of the symmetric matrix, the diagonal once."""
    ends = F.when(F.col("bin1_id") == F.col("bin2_id"), F.array("bin1_id")).otherwise(F.array("bin1_id", "bin2_id"))
    return pixels.select(F.explode(ends).alias("bin_id"), F.col(value).alias("_v")).groupBy("bin_id").agg(F.sum("_v").alias("total"))


def vanilla_coverage(pixels: DataFrame, root: bool = False) -> DataFrame:
    """Pixels with ``balanced``: the count over both rows' norms (their sums, or the square roots of those), norms scaled to a mean of 1."""
    sums = marginals(pixels)
    norm = F.sqrt("total") if root else F.col("total").cast("double")
    mean = sums.agg(F.avg(norm).alias("_m"))
    return divide_by(pixels, sums.join(F.broadcast(mean)).select("bin_id", (norm / F.col("_m")).alias("norm")))


def divide_by(pixels: DataFrame, norms: DataFrame) -> DataFrame:
    """Pixels with ``balanced`` = count over the product of both bins' norms; infinite where that is 0."""
    for k in (1, 2):
        pixels = pixels.join(norms.select(F.col("bin_id").alias(f"bin{k}_id"), F.col("norm").alias(f"_n{k}")), f"bin{k}_id")
    product = F.col("_n1") * F.col("_n2")
    return pixels.withColumn("balanced", F.when(product == 0, F.lit(float("inf"))).otherwise(F.col("count") / F.when(product != 0, product))).drop("_n1", "_n2").select("bin1_id", "bin2_id", "count", "balanced")


def balance(pixels: DataFrame, iterations: int = 50, tolerance: float = 1e-5, ignore_diagonals: int = 0) -> DataFrame:
    """(bin_id, weight): iterative correction (Imakaev et al. 2012), rows of the balanced matrix all sum to about 1 times a constant.

    A loop on the driver over grouped sums. The pixels are written once, each round's weights (a row per bin) in a table of their own that the next round's
    replaces, so no round computes anything twice, plans stay short, and a lost executor costs a reread.
    """
    used = written(pixels.where(F.col("bin2_id") - F.col("bin1_id") >= ignore_diagonals).select("bin1_id", "bin2_id", F.col("count").cast("double").alias("count")))
    weights = written(marginals(used).select("bin_id", F.lit(1.0).alias("weight"), F.lit(None).cast("double").alias("_d")))
    for _ in range(iterations):
        scaled = used
        for k in (1, 2):
            scaled = scaled.join(weights.select(F.col("bin_id").alias(f"bin{k}_id"), F.col("weight").alias(f"_w{k}")), f"bin{k}_id")
        sums = marginals(scaled.select("bin1_id", "bin2_id", (F.col("count") * F.col("_w1") * F.col("_w2")).alias("v")), "v")
        stats = sums.agg(F.avg("total").alias("m"))  # one row
        off = F.col("total") / F.col("m")
        now = written(weights.select("bin_id", "weight").join(sums, "bin_id").join(F.broadcast(stats)).select("bin_id", (F.col("weight") / F.sqrt(off)).alias("weight"), ((off - 1) * (off - 1)).alias("_d")))
        discard(weights)
        weights = now
        worst = now.agg(F.avg("_d").alias("d")).first()["d"]
        if worst is None or worst < tolerance:
            break
    discard(used)
    out = weights.select("bin_id", "weight")
    out._ligaspark_path = weights._ligaspark_path
    return out


def on_diagonal_bins(pixels: DataFrame) -> DataFrame:
    """Pixels between bins that have contacts within themselves. Such a matrix can be balanced (each of its cells lies on a permutation without zeros); others may not."""
    for k in (1, 2):
        pixels = pixels.join(_diagonal(pixels).withColumnRenamed("bin_id", f"bin{k}_id"), f"bin{k}_id", "left_semi")
    return pixels.select("bin1_id", "bin2_id", "count")


def _diagonal(pixels: DataFrame) -> DataFrame:
    return pixels.where("bin1_id = bin2_id AND count > 0").select(F.col("bin1_id").alias("bin_id"))


def knight_ruiz(pixels: DataFrame, iterations: int = 300, tolerance: float = 1e-9) -> DataFrame:
    """(bin_id, norm): the vector by whose products counts are divided so that every row sums to the mean row sum of the counts, by the method of Knight and Ruiz (2013).

    Sought is x > 0 with x * (A x) = 1 in every row. Newton's equation for the factors y by which x changes, (diag(x * A x) + X A X) (y - 1) = 1 - x * A x, is solved by conjugate
    gradients, preconditioned by its diagonal, only as far as the residual so far deserves; a step that would leave 0.1 < y < 3 is cut there. It ends where the norm of 1 - x * A x
    is at most ``tolerance``, or after so many products with the matrix: then, as for matrices that no x balances (see :func:`on_diagonal_bins`), with what it has. Bins whose counts are all 0 have no norm.

    A product is a join of the cells, written once, with a row per bin, and a sum by row; the vectors are a table per step that replaces the last; the driver sees sums over bins only.
    """
    cells = written(mirrored(pixels.where("count > 0")).select(F.col("bin1_id").alias("i"), F.col("bin2_id").alias("j"), F.col("count").cast("double").alias("a")))

    def times(vectors: DataFrame, value) -> DataFrame:
        """``vectors`` with ``t``, the matrix's product with a value of them; written."""
        sums = cells.join(vectors.select(F.col("bin_id").alias("j"), value.alias("_q")), "j").groupBy("i").agg(F.sum(F.col("a") * F.col("_q")).alias("t"))
        return written(vectors.join(sums.withColumnRenamed("i", "bin_id"), "bin_id"))

    def add(vectors: DataFrame, **values) -> list:
        return list(vectors.agg(*[f.alias(n) for n, f in values.items()]).first())

    x, v, r, p, y, t = map(F.col, "xvrpyt")
    start = cells.select(F.col("i").alias("bin_id")).distinct().select("bin_id", F.lit(1.0).alias("x"))
    now, done, forcing, before = times(start, x), 1, 0.1, None
    scale = add(now, mean=F.avg("t"))[0]  # the mean row sum of the counts; x begins where rows sum to 1 on average
    if scale is None:
        discard(cells)
        return now.select("bin_id", x.alias("norm"))
    now = _replaced(now, now.select("bin_id", F.lit(scale**-0.5).alias("x"), (t / scale).alias("v")))
    while True:
        rest = add(now, rest=F.sum((1 - v) * (1 - v)))[0]
        if before is not None and before > 0:
            forcing = min(0.1, max(0.9 * rest / before, 0.5 * tolerance / max(rest, tolerance**2) ** 0.5))
        if rest <= tolerance**2 or done >= iterations:
            break
        before = rest
        step = now.select("bin_id", "x", "v", (1 - v).alias("r"), ((1 - v) / v).alias("p"), F.lit(1.0).alias("y"))
        size = add(step, size=F.sum(r * r / v))[0]
        held = None
        while size > max(forcing**2 * rest, tolerance**2) and done < iterations:
            made = times(step, x * p)
            discard(*([held] if held is not None else []))
            held, done = made, done + 1
            w = x * t + v * p
            far = size / add(made, pw=F.sum(p * w))[0]
            room = F.min(F.when(p < 0, (0.1 - y) / p).when(p > 0, (3 - y) / p))
            reach, after = add(made, room=room, after=F.sum((r - far * w) * (r - far * w) / v))
            cut = reach is not None and reach <= far
            far = reach if cut else far
            step = made.select("bin_id", "x", "v", (r - far * w).alias("r"), ((r - far * w) / v + (after / size) * p).alias("p"), (y + far * p).alias("y"))
            size = after
            if cut:
                break
        moved = times(step.select("bin_id", (x * y).alias("x")), x)
        discard(*([held] if held is not None else []), now)
        now, done = _replaced(moved, moved.select("bin_id", "x", (x * t).alias("v"))), done + 1
    discard(cells)
    out = now.select("bin_id", (1 / (x * F.lit(scale) ** 0.5)).alias("norm"))
    out._ligaspark_path = now._ligaspark_path
    return out


def _replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """A frame over a written table, carrying its path on, so that it is deleted with it."""
    new._ligaspark_path = old._ligaspark_path
    return new


def apply_weights(pixels: DataFrame, weights: DataFrame) -> DataFrame:
    """Pixels with ``balanced`` = count times both bins' weights; bins without a weight give null."""
    for k in (1, 2):
        pixels = pixels.join(weights.select(F.col("bin_id").alias(f"bin{k}_id"), F.col("weight").alias(f"_w{k}")), f"bin{k}_id", "left")
    return pixels.select("bin1_id", "bin2_id", "count", (F.col("count") * F.col("_w1") * F.col("_w2")).alias("balanced"))
