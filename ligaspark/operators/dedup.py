"""De-duplication of contacts: exact, by fragment tags (two ways), and within a distance.

``exact`` is an aggregate over the whole key, combined before the shuffle; ``strict`` takes the first row of each key after one sort. ``islands`` and ``distance`` depend on an order; both group by more
than the chromosome pair, so that one pair of chromosomes is never one task: islands by the first fragment, distance by
the cuts between rows that cannot belong together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import BEDPE_KEY, PAIRS_KEY
from ..session import written
from .contacts import is_bedpe


# Tag groups are dealt out by a hash of their key, which is also the first key of the one sort that follows: sorts compare the first eight bytes of the first
# key, and those of several strings would be the same for most rows. Nothing is combined before the shuffle, as few rows of real libraries share their tags.


def _dealt(df: DataFrame, *key: str) -> DataFrame:
    """``df`` with ``_h``, the hash by which it is dealt out."""
    return df.withColumn("_h", F.xxhash64(*key)).repartition("_h")


def _line(df: DataFrame):
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns])


def exact(df: DataFrame) -> DataFrame:
    """One row per coordinates and strands, the one whose name, and then the rest, is smallest."""
    key = sorted(BEDPE_KEY if is_bedpe(df) else PAIRS_KEY, key=lambda c: c.startswith(("chr", "strand")))  # numbers first: the sort's prefix then tells most rows apart
    rest = list(dict.fromkeys(c for c in ["name", *df.columns] if c not in key))
    out = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    return out.select(*df.columns)


def strict(df: DataFrame) -> DataFrame:
    """One row per chromosomes, fragment tags and strands: the smallest by its other columns in their order."""
    _need_tags(df)
    key = ["tag1", "tag2", "chr1", "chr2", "strand1", "strand2"]
    w = Window.partitionBy("_h", *key).orderBy(*[c for c in df.columns if c not in key])
    return _dealt(df, *key).withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*df.columns)


def islands(df: DataFrame) -> DataFrame:
    """Rows that differ in second tag or strands from the row before, ordered by the first distance as text: equal rows that are apart both stay."""
    _need_tags(df)
    rows = _dealt(df, "tag1", "chr1", "chr2").withColumn("_line", _line(df))
    w = Window.partitionBy("_h", "tag1", "chr1", "chr2").orderBy(F.col("dis1").cast("string"), "strand1", "strand2", "_line")
    mine = F.struct("tag2", "strand1", "strand2")
    return rows.withColumn("_p", F.lag(mine).over(w)).where(F.col("_p").isNull() | (F.col("_p") != mine)).select(*df.columns)


def distance(df: DataFrame, most: int) -> DataFrame:
    """Greedy runs: a row goes if each coordinate is within ``most`` of the last kept row's and chromosomes and strands are the same.

    Rows come in the order of the sort. The last kept row is the row before or within ``most`` of it in every coordinate, so a row whose strands differ from the
    row before, or of which a coordinate is more than twice ``most`` away from it, surely stays and begins a run of its own. Those cuts come from one window over
    bins of the first coordinate, whose result is written; most runs are single rows, which stay without a further look, and only the rest is scanned in order.
    """
    first = ["start1", "start2", "end1", "end2"] if is_bedpe(df) else ["pos1", "pos2"]
    columns = list(df.columns)
    place = F.struct(*first, "strand1", "strand2")
    rows = df.withColumn("_bin", F.floor(F.col(first[0]) / F.lit(max(1, most) * 4096)))
    within = Window.partitionBy("chr1", "chr2", "_bin").orderBy(*first, "strand1", "strand2", "name")
    along = Window.partitionBy("chr1", "chr2").orderBy("_bin")  # over one row per bin
    ends = rows.groupBy("chr1", "chr2", "_bin").agg(F.max(place).alias("_last"))
    below = ends.select("chr1", "chr2", "_bin", F.lag("_last").over(along).alias("_l")).where("_l is not null")
    # each bin begins with a copy of the last place below it, which sorts before all of its rows
    below = below.select("chr1", "chr2", "_bin", *[F.col(f"_l.{c}").alias(c) for c in (*first, "strand1", "strand2")], F.lit(True).alias("_copy"))
    rows = rows.withColumn("_copy", F.lit(False)).unionByName(below, allowMissingColumns=True)
    cut = F.lag("chr1").over(within).isNull()
    for c in first:
        cut = cut | (F.abs(F.col(c) - F.lag(c).over(within)) > 2 * most)
    for c in ("strand1", "strand2"):
        cut = cut | (F.col(c) != F.lag(c).over(within))
    rows = rows.withColumn("_cut", F.when(F.col("_copy"), 0).otherwise(cut.cast("long")).cast("long")).withColumn("_run", F.sum("_cut").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_alone", (F.col("_cut") == 1) & (F.lead("_cut").over(within) == 1)).where(~F.col("_copy"))
    rows = written(rows.select(*columns, "_bin", "_cut", "_run", F.coalesce("_alone", F.lit(False)).alias("_alone")))  # read three times below
    # runs go on over bins: the first rows of a bin that are no cut belong to the last run of the bin before
    counts = rows.groupBy("chr1", "chr2", "_bin").agg(F.sum("_cut").alias("_n"))
    starts = counts.select("chr1", "chr2", "_bin", F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    alone = rows.where("_alone").select(*columns)
    rest = rows.where("not _alone").join(starts, ["chr1", "chr2", "_bin"]).withColumn("_run", F.col("_base") + F.col("_run"))
    placed = rest.repartition("chr1", "chr2", "_run").sortWithinPartitions("chr1", "chr2", "_run", *first, "strand1", "strand2", "name").select(*columns, "_run")
    width = len(columns)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # run, coordinates and strands of the row kept last
        at = [columns.index(c) for c in first]
        names = [columns.index(c) for c in ("chr1", "chr2", "strand1", "strand2")]
        for batch in batches:
            if not batch.num_rows:
                continue
            run = batch.column(width).to_numpy()
            chrom = [batch.column(i).to_numpy(zero_copy_only=False) for i in names[:2]]
            strand = [batch.column(i).to_numpy(zero_copy_only=False) for i in names[2:]]
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in at], axis=1)
            begins = np.ones(len(run), dtype=bool)
            begins[1:] = (run[1:] != run[:-1]) | (chrom[0][1:] != chrom[0][:-1]) | (chrom[1][1:] != chrom[1][:-1])
            here = (run[0], chrom[0][0], chrom[1][0])
            start = np.flatnonzero(begins)
            size = np.diff(np.append(start, len(run)))
            keep = begins.copy()
            base, marks = x[start], [s[start] for s in strand]
            if last is not None and last[0] == here:  # goes on from the batch before
                keep[0] = (np.abs(x[0] - last[1]) > most).any() or strand[0][0] != last[2] or strand[1][0] != last[3]
                if not keep[0]:
                    base[0] = last[1]
                    marks[0][0], marks[1][0] = last[2], last[3]
            live = np.flatnonzero(size > 1)
            step = 1
            while len(live):  # all runs of the batch advance together, a row at a time
                i = start[live] + step
                far = (np.abs(x[i] - base[live]) > most).any(axis=1) | (strand[0][i] != marks[0][live]) | (strand[1][i] != marks[1][live])
                keep[i[far]] = True
                new = live[far]
                base[new] = x[i[far]]
                marks[0][new], marks[1][new] = strand[0][i[far]], strand[1][i[far]]
                step += 1
                live = live[size[live] > step]
            last = ((run[-1], chrom[0][-1], chrom[1][-1]), base[-1], marks[0][-1], marks[1][-1])
            yield batch.select(list(range(width))).filter(pa.array(keep))

    return alone.unionByName(placed.mapInArrow(scan, df.schema))


def dedup(df: DataFrame, mode: str = "exact", most: int = 0) -> DataFrame:
    """``mode``: exact, etag (islands), etag_strict or distance."""
    if mode == "distance" and most > 0:
        return distance(df, most)
    return {"exact": exact, "distance": exact, "etag": islands, "etag_strict": strict}[mode](df)


def _need_tags(df: DataFrame) -> None:
    if missing := {"tag1", "dis1", "tag2", "dis2"} - set(df.columns):
        raise ValueError(f"no fragment tags: {', '.join(sorted(missing))} missing; classify the contacts first")
