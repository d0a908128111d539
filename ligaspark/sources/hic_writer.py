"""Writer of binary ``.hic`` matrices, version 8, that :mod:`hic` and other readers of the format read.

Workers cut each resolution's pixels into blocks, encode and compress them; a block holds at most ``BLOCK`` bins square. The blocks go to a table, sorted by place.
The file is one sequence of bytes, so the driver writes it: it takes the blocks' sizes first, from which every position follows, and then streams the blocks past,
one at a time.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import expected, matrix
from ..session import discard, written

BLOCK = 1000
VERSION = 8


def encode_block(x: np.ndarray, y: np.ndarray, count: np.ndarray) -> bytes:
    """Cells of one block as rows of (y, its x and counts); counts as 16-bit integers where all of them are such, else as floats."""
    order = np.lexsort((x, y))
    x, y, count = x[order], y[order], count[order]
    x0, y0 = int(x.min()), int(y.min())
    wide = bool((count != np.floor(count)).any() or (count <= -32768).any() or (count > 32767).any())
    out = [struct.pack("<iiibb", len(x), x0, y0, int(wide), 1)]
    first = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]]))
    out.append(struct.pack("<h", len(first)))
    cell = np.dtype([("x", "<i2"), ("c", "<f4" if wide else "<i2")])
    cells = np.empty(len(x), dtype=cell)
    cells["x"], cells["c"] = x - x0, count
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(x)], strict=True):
        out.append(struct.pack("<hh", int(y[a]) - y0, z - a) + cells[a:z].tobytes())
    return zlib.compress(b"".join(out))


def block_table(pixels: DataFrame, sizes: DataFrame, resolution: int, position: int) -> DataFrame:
    """(c1, c2, r, block, data, n, total) of one resolution; chromosomes count from 1, as 0 stands for the whole genome."""
    bins = matrix.make_bins(sizes, resolution).join(sizes.select("chrom", (F.col("ord") + 1).alias("c"), F.ceil(F.col("length") / resolution).alias("w")), "chrom")
    bins = bins.select("bin_id", "c", "w", F.expr(f"start div {resolution}").alias("b"))
    both = pixels
    for k in (1, 2):
        both = both.join(bins.select(F.col("bin_id").alias(f"bin{k}_id"), F.col("c").alias(f"c{k}"), F.col("b").alias(f"b{k}"), F.col("w").alias(f"w{k}")), f"bin{k}_id")
    columns = F.ceil(F.greatest("w1", "w2") / BLOCK)
    both = both.withColumn("block", F.expr(f"b2 div {BLOCK}") * columns + F.expr(f"b1 div {BLOCK}"))
    cells = both.groupBy("c1", "c2", "block").agg(F.collect_list(F.struct("b1", "b2", F.col("count").cast("double").alias("count"))).alias("cells"))  # BLOCK squared at most

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(3).slice(i, 1).flatten()
                x, y, count = (own.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([position], pa.int32()), batch.column(2).slice(i, 1), pa.array([encode_block(x, y, count)], pa.binary()), pa.array([len(x)], pa.int64()), pa.array([float(count.sum())])],
                    names=["c1", "c2", "r", "block", "data", "n", "total"],
                )

    return cells.mapInArrow(run, "c1 int, c2 int, r int, block long, data binary, n long, total double")


def _text(s: str) -> bytes:
    return s.encode() + b"\0"


def write_hic(spark: SparkSession, pixels: dict[int, DataFrame], sizes: DataFrame, path: str, genome: str = "unknown", norms: dict[str, dict[int, DataFrame]] | None = None) -> None:
    """``pixels``: a matrix of (bin1_id, bin2_id, count) for each resolution; ``norms``: for a normalization's name and a resolution, (bin_id, norm)."""
    resolutions = sorted(pixels, reverse=True)
    chroms = [(r["chrom"], r["length"]) for r in sizes.orderBy("ord").collect()]
    made = None
    for i, r in enumerate(resolutions):
        part = block_table(pixels[r], sizes, r, i)
        made = part if made is None else made.unionByName(part)
    blocks = written(made.orderBy("c1", "c2", "r", "block"))
    index = blocks.select("c1", "c2", "r", "block", F.length("data").alias("size"), "n", "total").orderBy("c1", "c2", "r", "block").collect()  # a row for up to a million cells

    every = [("All", sum(n for _, n in chroms) // 1000), *chroms]
    rest = _text(genome) + struct.pack("<i", 0) + struct.pack("<i", len(every)) + b"".join(_text(c) + struct.pack("<i", n) for c, n in every)
    rest += struct.pack("<i", len(resolutions)) + b"".join(struct.pack("<i", r) for r in resolutions) + struct.pack("<i", 0)
    at = 4 + 4 + 8 + len(rest)
    place: dict[tuple, tuple[int, int]] = {}
    for row in index:
        place[row["c1"], row["c2"], row["r"], row["block"]] = (at, row["size"])
        at += row["size"]
    bodies, entries = [], []
    for pair in sorted({(row["c1"], row["c2"]) for row in index}):
        own = [row for row in index if (row["c1"], row["c2"]) == pair]
        body = struct.pack("<iii", *pair, len({row["r"] for row in own}))
        for r in sorted({row["r"] for row in own}):
            here = [row for row in own if row["r"] == r]
            columns = -(-max(-(-chroms[c - 1][1] // resolutions[r]) for c in pair) // BLOCK)
            body += _text("BP") + struct.pack("<iffff", r, sum(row["total"] for row in here), sum(row["n"] for row in here), 0.0, 0.0) + struct.pack("<iiii", resolutions[r], BLOCK, columns, len(here))
            body += b"".join(struct.pack("<iqi", row["block"], *place[*pair, r, row["block"]]) for row in here)
        entries.append(_text(f"{pair[0]}_{pair[1]}") + struct.pack("<qi", at, len(body)))
        bodies.append(body)
        at += len(body)
    vectors, listed = [], []
    for name, by in sorted((norms or {}).items()):
        for r, df in sorted(by.items()):
            starts = {x["chrom"]: (x["offset"], x["n_bins"]) for x in matrix.genome_offsets(sizes, r).collect()}
            values = {x["bin_id"]: x["norm"] for x in df.collect()}  # a vector is as long as the genome has bins
            for c, (chrom, _) in enumerate(chroms, 1):
                base, n = starts[chrom]
                data = struct.pack("<i", n) + np.array([values.get(base + k, np.nan) for k in range(n)], "<f8").tobytes()
                listed.append(_text(name) + struct.pack("<i", c) + _text("BP") + struct.pack("<i", r) + struct.pack("<qi", at, len(data)))
                vectors.append(data)
                at += len(data)
    number = {c: k for k, (c, _) in enumerate(chroms, 1)}
    hoped = b""
    for r in resolutions:
        values, factors = expected.expected(pixels[r], sizes, r)
        hoped += _text("BP") + struct.pack("<ii", r, len(values)) + np.asarray(values, "<f8").tobytes()
        hoped += struct.pack("<i", len(factors)) + b"".join(struct.pack("<id", number[c], f) for c, f in factors.items())
    footer = struct.pack("<i", len(entries)) + b"".join(entries) + struct.pack("<i", len(resolutions)) + hoped + struct.pack("<i", 0)
    footer = struct.pack("<i", len(footer)) + footer + struct.pack("<i", len(listed)) + b"".join(listed)

    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(b"HIC\0" + struct.pack("<iq", VERSION, at) + rest))
    for row in blocks.orderBy("c1", "c2", "r", "block").select("data").toLocalIterator():
        out.write(bytearray(row["data"]))
    for data in [*bodies, *vectors, footer]:
        out.write(bytearray(data))
    out.close()
    discard(blocks)
