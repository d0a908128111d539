"""Restriction fragments: sites of a genome, nearest-fragment assignment of contact ends, and classes of contacts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement_text, site_starts
from ..genome import Site
from ..session import written

#: Sites up to which the position arrays are sent to the workers (8 bytes each, 16 MB in all); beyond, ends are joined with bins of sites.
BROADCAST_SITES = 2_000_000
SITES_PER_BIN = 8


def scan_sites(fasta: DataFrame, site: Site) -> DataFrame:
    """(chrom, strand, pos): cut positions in every sequence, with the bounds 0 and length on ``+``; a second scan on ``-`` if the site is no palindrome."""
    cuts = lambda seq, strand: fasta.select(F.col("name").alias("chrom"), F.lit(strand).alias("strand"), F.explode(F.transform(site_starts(F.col("seq"), seq), lambda p: (p + site.cut).cast("long"))).alias("pos"))
    bounds = fasta.select(F.col("name").alias("chrom"), F.lit("+").alias("strand"), F.explode(F.array(F.lit(0).cast("long"), F.length("seq").cast("long"))).alias("pos"))
    out = cuts(site.seq, "+").union(bounds)
    other = reverse_complement_text(site.seq)
    return (out if other.upper() == site.seq.upper() else out.union(cuts(other, "-"))).distinct()


def restriction_fragments(sites: DataFrame) -> DataFrame:
    """BED rows between consecutive positions (bounds included) of each chromosome."""
    w = Window.partitionBy("chrom").orderBy("pos")
    rows = sites.select("chrom", F.col("pos").alias("start"), F.lead("pos").over(w).alias("end")).where("end is not null")
    return rows.select(F.col("chrom").alias("chr"), "start", "end", F.lit(".").alias("name"), F.lit(0).alias("score"), F.lit("+").alias("strand"))


def fragment_lengths(sites: DataFrame) -> DataFrame:
    """(chrom, length): distances of consecutive positions."""
    w = Window.partitionBy("chrom").orderBy("pos")
    return sites.select("chrom", F.abs(F.col("pos") - F.lag("pos").over(w)).alias("length")).where("length is not null")


def inner_sites(positions: DataFrame) -> DataFrame:
    """(chrom, pos) strictly inside each chromosome: without the first and the last position, which are its bounds."""
    ends = positions.groupBy("chrom").agg(F.min("pos").alias("_a"), F.max("pos").alias("_z"))
    return positions.join(ends, "chrom").where("pos > _a and pos < _z").select("chrom", "pos")


# ---------------------------------------------------------------- nearest fragment

def nearest_rule(fs, fe, lo, hi, start, end):
    """The rule, over NumPy arrays; lo or hi is masked out by -1 in fs or by the flag ``hi < 0`` of no site."""
    none_above = hi < 0
    near_lo = np.abs(start - lo) < np.abs(end - hi)
    first = fs <= 0
    idx = np.where(first, fs, np.where(none_above, fe, np.where(near_lo, fs, fe)))
    side = np.where(first, "t", np.where(none_above, "s", np.where(near_lo, "s", "t")))
    dis = np.where(first, end - hi, np.where(none_above, start - lo, np.where(near_lo, start - lo, end - hi)))
    return idx, side, dis, first & none_above


def _by_arrays(df: DataFrame, sites: DataFrame, site_len: int) -> DataFrame:
    held = sites.select("chrom", "pos").distinct().toPandas()  # checked against BROADCAST_SITES
    arrays = {c: np.sort(g["pos"].to_numpy(np.int64)) for c, g in held.groupby("chrom")}
    sent = df.sparkSession.sparkContext.broadcast(arrays)

    @F.pandas_udf("idx long, before boolean, dis long")
    def nearest(chrom: pd.Series, start: pd.Series, end: pd.Series) -> pd.DataFrame:
        n = len(chrom)
        idx, before, dis, unknown = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int64), np.zeros(n, bool)
        s, e = start.to_numpy(np.int64), end.to_numpy(np.int64)
        codes, names = pd.factorize(chrom)
        for k, name in enumerate(names):
            p = sent.value.get(name)
            if p is None or not len(p):
                continue
            at = np.flatnonzero(codes == k)
            fs, fe = np.searchsorted(p, s[at] + 1, side="right"), np.searchsorted(p, e[at] - site_len - 1, side="right")
            lo = p[np.maximum(fs - 1, 0)]
            hi = np.where(fe < len(p), p[np.minimum(fe, len(p) - 1)], -1)
            idx[at], side, dis[at], unknown[at] = nearest_rule(fs, fe, lo, hi, s[at], e[at])
            before[at] = side == "s"
        return pd.DataFrame({"idx": idx, "before": before, "dis": pd.arrays.IntegerArray(dis, unknown)})

    found = df.withColumns({f"_f{k}": nearest(f"chr{k}", f"start{k}", f"end{k}") for k in (1, 2)})
    return found.withColumns({f"_f{k}": F.struct(F.col(f"_f{k}.idx").alias("idx"), F.when(F.col(f"_f{k}.before"), "s").otherwise("t").alias("side"), F.col(f"_f{k}.dis").alias("dis")) for k in (1, 2)})


def site_bins(sites: DataFrame, width: int) -> DataFrame:
    """(chrom, bin, inside, rank, below, above): the sites of each bin in order, how many lie before it, and the nearest ones outside."""
    ranked = sites.distinct().select("chrom", "pos", F.expr(f"pos div {width}").alias("bin"))
    full = ranked.groupBy("chrom", "bin").agg(F.sort_array(F.collect_list("pos")).alias("inside"))
    every = ranked.groupBy("chrom").agg(F.max("bin").alias("b")).select("chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b") + 1)).alias("bin"))
    w = Window.partitionBy("chrom").orderBy("bin")
    up, down = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    grid = every.join(full, ["chrom", "bin"], "left")
    n = F.coalesce(F.size("inside"), F.lit(0))
    return grid.select(
        "chrom", "bin", F.coalesce("inside", F.array().cast("array<bigint>")).alias("inside"), F.coalesce(F.sum(F.when(F.col("inside").isNull(), 0).otherwise(n)).over(up), F.lit(0)).alias("rank"),
        F.last(F.element_at("inside", -1), ignorenulls=True).over(up).alias("below"), F.first(F.element_at("inside", 1), ignorenulls=True).over(down).alias("above"),
    )


def _by_bins(df: DataFrame, sites: DataFrame, site_len: int) -> DataFrame:
    size = sites.groupBy("chrom").agg(F.count_distinct("pos").alias("n"), F.max("pos").alias("z")).agg(F.sum("n").alias("n"), F.sum("z").alias("z")).first()
    width = max(1, int((size["z"] or 0) * SITES_PER_BIN / max(1, size["n"] or 0)))
    bins = written(site_bins(sites, width))  # read by each of the joins below
    tops = bins.groupBy("chrom").agg(F.max("bin").alias("_top"))
    for k in (1, 2):
        df = df.join(F.broadcast(tops.withColumnRenamed("chrom", f"chr{k}")), f"chr{k}", "left")
        for name, probe in (("s", F.col(f"start{k}") + 1), ("e", F.col(f"end{k}") - site_len - 1)):
            df = df.withColumn("_x", probe).withColumn("_b", F.least(F.greatest(F.expr(f"_x div {width}"), F.lit(0)), F.col("_top")))
            b = bins.select(F.col("chrom").alias(f"chr{k}"), F.col("bin").alias("_b"), "inside", "rank", "below", "above")
            df = df.join(b, [f"chr{k}", "_b"], "left")
            low = F.filter("inside", lambda p: p <= F.col("_x"))
            high = F.filter("inside", lambda p: p > F.col("_x"))
            df = df.withColumns({f"_r{name}": F.col("rank") + F.size(low), f"_lo{name}": F.coalesce(F.try_element_at(low, F.lit(-1)), F.col("below")), f"_hi{name}": F.coalesce(F.try_element_at(high, F.lit(1)), F.col("above"))}).drop("_x", "_b", "inside", "rank", "below", "above")
        s, e = F.col(f"start{k}"), F.col(f"end{k}")
        near = F.abs(s - F.col("_los")) < F.abs(e - F.col("_hie"))
        to_hi, to_lo = e - F.col("_hie"), s - F.col("_los")
        rule = lambda first, last, lo, hi: F.when(F.col("_rs") <= 0, first).when(F.col("_hie").isNull(), last).when(near, lo).otherwise(hi)  # noqa: B023, E731
        found = F.struct(rule(F.col("_rs"), F.col("_re"), F.col("_rs"), F.col("_re")).alias("idx"), rule(F.lit("t"), F.lit("s"), F.lit("s"), F.lit("t")).alias("side"), rule(to_hi, to_lo, to_lo, to_hi).alias("dis"))
        nothing = F.struct(F.lit(0).cast("long").alias("idx"), F.lit("s").alias("side"), F.lit(0).cast("long").alias("dis"))
        df = df.withColumn(f"_f{k}", F.when(F.col("_top").isNull(), nothing).otherwise(found)).drop("_top", *[f"_{a}{b}" for a in ("r", "lo", "hi") for b in "se"])
    return df


def find_fragments(df: DataFrame, sites: DataFrame, site_len: int, method: str = "auto") -> DataFrame:
    """Contacts with frag1, side1, dis1, frag2, side2, dis2: index of the fragment of each end, the site it is nearest to (``s``: before, ``t``: after), and the
    signed distance. ``method``: arrays (sent to the workers, no shuffle), bins (an equi-join), or by the number of sites."""
    if method == "auto":
        method = "arrays" if sites.limit(BROADCAST_SITES + 1).count() <= BROADCAST_SITES else "bins"
    found = (_by_arrays if method == "arrays" else _by_bins)(df, sites, site_len)
    ends = {f"{new}{k}": F.col(f"_f{k}.{old}") for k in (1, 2) for new, old in (("frag", "idx"), ("side", "side"), ("dis", "dis"))}
    return found.withColumns(ends).drop("_f1", "_f2").select(*df.columns, *ends)


# ---------------------------------------------------------------- classes

NORMAL, SELF, RE = "normal", "self-ligation", "re-ligation"


def contact_type(threshold: int = -1) -> Column:
    """Class by fragments; with a threshold, intra-chromosomal contacts farther apart than it, and all others across chromosomes, are normal outright."""
    inter = F.col("chr1") != F.col("chr2")
    far = F.lit(False) if threshold == -1 else F.abs(F.col("start1") - F.col("start2")) > threshold
    facing = (F.col("frag2") - F.col("frag1") == 1) & (F.col("side2") == "s") & (F.col("side1") == "t")
    return F.when(inter | far, NORMAL).when(F.col("frag1") == F.col("frag2"), SELF).when(facing, RE).otherwise(NORMAL)


def classify(df: DataFrame, sites: DataFrame, site_len: int, threshold: int = -1, method: str = "auto") -> DataFrame:
    """Contacts with their fragments, class, and the tags ``index-side``. With a threshold, contacts that it settles have no fragments.

    Contacts that need their fragments and have an end on a chromosome without sites are dropped, as nothing is known of them: without a threshold those are all
    contacts, across chromosomes too; with one, those within a chromosome that it does not settle.
    """
    settled = F.lit(False) if threshold == -1 else (F.col("chr1") != F.col("chr2")) | (F.abs(F.col("start1") - F.col("start2")) > threshold)
    names = sites.select("chrom").distinct()  # chromosomes: a few hundred rows at most
    for k in (1, 2):
        df = df.join(F.broadcast(names.select(F.col("chrom").alias(f"_c{k}"))), F.col(f"chr{k}") == F.col(f"_c{k}"), "left")
    known = F.col("_c1").isNotNull() & F.col("_c2").isNotNull()
    df = df.where(settled | known).drop("_c1", "_c2")
    found = find_fragments(df, sites, site_len, method)
    found = found.withColumn("type", contact_type(threshold))
    if threshold != -1:
        found = found.withColumns({c: F.when(~settled, F.col(c)) for c in ("frag1", "side1", "dis1", "frag2", "side2", "dis2")})
    return found.withColumns({f"tag{k}": F.concat_ws("-", F.when(F.col(f"frag{k}").isNotNull(), F.col(f"frag{k}").cast("string")), F.col(f"side{k}")) for k in (1, 2)})


def routed(classified: DataFrame) -> dict[str, DataFrame]:
    """The three outputs of classification."""
    return {t: classified.where(F.col("type") == t) for t in (NORMAL, SELF, RE)}
