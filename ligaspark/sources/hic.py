"""Reader of binary ``.hic`` matrices (versions 6 to 8), little-endian, through Hadoop's file systems.

The driver reads the header and the footer's index; tasks get the positions of the blocks that a region needs, read them, inflate and decode them. Where a file is in a
store that only the driver's session reaches, the driver reads the blocks instead, and hands them on a few megabytes at a time.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..genome import Region
from ..session import written


_HANDED = 16_000_000  # bytes of blocks that the driver holds at once where it has to read them


class Bytes:
    """A cursor over a byte source: anything with ``read_at(position, n) -> bytes``."""

    def __init__(self, source, at: int = 0, chunk: int = 1 << 16):
        self.source, self.at, self.chunk = source, at, chunk
        self.base, self.held = 0, b""

    def take(self, n: int) -> bytes:
        if not (self.base <= self.at and self.at + n <= self.base + len(self.held)):
            self.base, self.held = self.at, self.source.read_at(self.at, max(n, self.chunk))
        out = self.held[self.at - self.base : self.at - self.base + n]
        if len(out) < n:
            raise EOFError(f"{n} bytes wanted at {self.at}")
        self.at += n
        return out

    def skip(self, n: int) -> None:
        self.at += n

    def numbers(self, fmt: str):
        got = struct.unpack("<" + fmt, self.take(struct.calcsize("<" + fmt)))
        return got[0] if len(got) == 1 else got

    def text(self) -> str:
        out = bytearray()
        while (c := self.take(1)) != b"\0":
            out += c
        return out.decode()


class HadoopFile:
    """``read_at`` by way of the session's file systems, so from any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        sc = spark.sparkContext
        self.jvm = sc._jvm
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        self.size = fs.getFileStatus(p).getLen()
        self.stream = fs.open(p)

    def read_at(self, position: int, n: int) -> bytes:
        n = max(0, min(n, self.size - position))
        self.stream.seek(position)
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n)) if n else b""


class LocalFile:
    def __init__(self, path: str):
        self.file = open(path, "rb")  # noqa: SIM115

    def read_at(self, position: int, n: int) -> bytes:
        self.file.seek(position)
        return self.file.read(n)


@dataclass
class Header:
    version: int
    master: int
    genome: str
    attributes: dict[str, str]
    chromosomes: list[tuple[str, int]]
    resolutions: list[int]


def read_header(source) -> Header:
    b = Bytes(source)
    if b.take(4) != b"HIC\0":
        raise ValueError("no .hic file")
    version, master = b.numbers("i"), b.numbers("q")
    if version < 6:
        raise ValueError(f"version {version} is not supported")
    name = b.text()
    attributes = {b.text(): b.text() for _ in range(b.numbers("i"))}
    chroms = [(b.text(), b.numbers("i")) for _ in range(b.numbers("i"))]
    return Header(version, master, name, attributes, chroms, [b.numbers("i") for _ in range(b.numbers("i"))])


def read_footer(source, master: int) -> tuple[dict[str, tuple[int, int]], dict[tuple, tuple[int, int]]]:
    """Positions and sizes of matrices by ``c1_c2``, and of normalization vectors by (type, chromosome number, unit, width)."""
    matrices, vectors, _ = _footer(source, master, False)
    return matrices, vectors


def read_expected(source, master: int) -> dict[tuple, tuple[np.ndarray, dict[int, float]]]:
    """By (type, unit, width): expected counts by distance in bins, and by chromosome number what they are divided by. Type NONE is of counts as they are."""
    return _footer(source, master, True)[2]


def _footer(source, master: int, wanted: bool):
    b = Bytes(source, master)
    b.numbers("i")
    matrices = {}
    for _ in range(b.numbers("i")):
        key = b.text()
        matrices[key] = b.numbers("qi")
    expected = {}
    for normed in (False, True):
        for _ in range(b.numbers("i")):
            key = (b.text() if normed else "NONE", b.text(), b.numbers("i"))
            n = b.numbers("i")
            values = np.frombuffer(b.take(8 * n), "<f8") if wanted else b.skip(8 * n)
            factors = np.frombuffer(b.take(12 * b.numbers("i")), np.dtype([("c", "<i4"), ("f", "<f8")]))
            expected[key] = (values, dict(zip(factors["c"].tolist(), factors["f"].tolist(), strict=True)))
    vectors = {}
    for _ in range(b.numbers("i")):
        key = (b.text(), b.numbers("i"), b.text(), b.numbers("i"))
        vectors[key] = b.numbers("qi")
    return matrices, vectors, expected


def block_index(source, position: int, unit: str, width: int) -> tuple[int, int, dict[int, tuple[int, int]]]:
    """(bins per block, blocks per row, {block: (position, size)}) of one matrix at one width."""
    b = Bytes(source, position)
    b.numbers("ii")
    for _ in range(b.numbers("i")):
        own = b.text()
        b.numbers("i")
        b.take(16)
        bin_, per, columns = b.numbers("iii")
        blocks = {k: (p, n) for k, p, n in (b.numbers("iqi") for _ in range(b.numbers("i")))}
        if own == unit and bin_ == width:
            return per, columns, blocks
    raise ValueError(f"no {unit} matrix at {width}")


def decode_block(data: bytes, version: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin numbers along both axes and counts."""
    raw = zlib.decompress(data)
    n = struct.unpack_from("<i", raw)[0]
    if version < 7:
        rows = np.frombuffer(raw, np.dtype([("x", "<i4"), ("y", "<i4"), ("c", "<f4")]), n, 4)
        return rows["x"].astype(np.int64), rows["y"].astype(np.int64), rows["c"].astype(float)
    x0, y0, wide, kind = struct.unpack_from("<iibb", raw, 4)
    at, value, missing = 14, ("<f4" if wide else "<i2"), -32768
    xs, ys, cs = [], [], []
    if kind == 1:
        rows = struct.unpack_from("<h", raw, at)[0]
        at += 2
        cell = np.dtype([("x", "<i2"), ("c", value)])
        for _ in range(rows):
            y, k = struct.unpack_from("<hh", raw, at)
            part = np.frombuffer(raw, cell, k, at + 4)
            at += 4 + k * cell.itemsize
            xs.append(part["x"].astype(np.int64) + x0), ys.append(np.full(k, y + y0, np.int64)), cs.append(part["c"].astype(float))
    elif kind == 2:
        points, width = struct.unpack_from("<ih", raw, at)
        c = np.frombuffer(raw, value, points, at + 6).astype(float)
        i = np.arange(points)
        ok = ~np.isnan(c) if wide else c != missing
        xs, ys, cs = [i[ok] % width + x0], [i[ok] // width + y0], [c[ok]]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(xs) if xs else empty), (np.concatenate(ys) if ys else empty), (np.concatenate(cs) if cs else empty.astype(float))


def norm_vector(source, position: int) -> np.ndarray:
    b = Bytes(source, position)
    n = b.numbers("i")
    return np.frombuffer(b.take(8 * n), "<f8")


def task_reader(path: str):
    """A function that opens the file in a task, or None if its store is not one that workers reach by themselves."""
    try:
        store, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:/") else f"file://{os.path.abspath(path)}")
        if store.get_file_info(inner).type != fs.FileType.File:
            return None
    except (pa.ArrowInvalid, OSError, NotImplementedError):
        return None
    uri = path

    def opened():
        own, place = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{inner}")
        return own.open_input_file(place)

    return opened


def blocks_of(bins1: tuple[int, int], bins2: tuple[int, int], per: int, columns: int, intra: bool) -> list[int]:
    """Numbers of the blocks that a rectangle of bins touches, in both triangles within a chromosome."""
    a = range(bins1[0] // per, bins1[1] // per + 1)
    z = range(bins2[0] // per, bins2[1] // per + 1)
    found = {r * columns + c for c in a for r in z}
    return sorted(found | ({r * columns + c for c in z for r in a} if intra else set()))


def read_hic(spark: SparkSession, path: str, region1: Region, region2: Region | None = None, width: int | None = None, unit: str = "BP", norm: str = "NONE", source=None, over_expected: bool = False) -> DataFrame:
    """(x, y, count) of a region, positions of bin starts. ``norm``: NONE, VC, VC_SQRT or KR, by which counts are divided (infinite where both norms' product is 0).
    ``over_expected``: within a chromosome, counts over what the file says is expected at their distance (of that ``norm``); infinite where that is 0."""
    given, source = source is not None, source or HadoopFile(spark, path)
    head = read_header(source)
    number = {c.removeprefix("chr"): i for i, (c, _) in enumerate(head.chromosomes)}
    region2 = region2 or region1
    swapped = number[region1.chrom.removeprefix("chr")] > number[region2.chrom.removeprefix("chr")]
    one, two = (region2, region1) if swapped else (region1, region2)
    c1, c2 = number[one.chrom.removeprefix("chr")], number[two.chrom.removeprefix("chr")]
    width = width or min(head.resolutions)
    matrices, vectors = read_footer(source, head.master)
    schema = "x long, y long, count double"
    if f"{c1}_{c2}" not in matrices:
        return spark.createDataFrame([], schema)
    per, columns, blocks = block_index(source, matrices[f"{c1}_{c2}"][0], unit, width)
    limits = [(r.start or 0, r.end if r.end is not None else head.chromosomes[c][1]) for r, c in ((one, c1), (two, c2))]
    wanted = blocks_of(*[(a // width, z // width) for a, z in limits], per, columns, c1 == c2)
    places = [blocks[k] for k in wanted if k in blocks]
    norms = None if norm == "NONE" else [norm_vector(source, vectors[(norm, c, unit, width)][0]) for c in (c1, c2)]
    hoped = None
    if over_expected:
        if c1 != c2:
            raise ValueError("expected counts are of cells within a chromosome")
        found = read_expected(source, head.master)
        if (norm, unit, width) not in found:
            raise ValueError(f"the file holds no expected counts of {norm} at {width}")
        values, factors = found[norm, unit, width]
        hoped = values / factors.get(c1, 1.0)
    version, sent, wanted_over = head.version, spark.sparkContext.broadcast(norms), spark.sparkContext.broadcast(hoped)  # as long as the chromosomes have bins

    reach = None if given else task_reader(path)

    def run(batches) -> Iterator[pa.RecordBatch]:
        file = reach() if reach else None
        for batch in batches:
            for at, size, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is not None:
                    file.seek(at)
                    data = file.read(size)
                x, y, c = decode_block(data, version)
                if sent.value is not None:
                    with np.errstate(divide="ignore", invalid="ignore"):
                        product = sent.value[0][x] * sent.value[1][y]
                        c = np.where(product == 0, np.inf, c / product)
                if wanted_over.value is not None:
                    with np.errstate(divide="ignore", invalid="ignore"):
                        here = wanted_over.value[np.minimum(np.abs(x - y), len(wanted_over.value) - 1)]
                        c = np.where(here == 0, np.inf, c / here)
                yield pa.RecordBatch.from_arrays([pa.array(x * width), pa.array(y * width), pa.array(c)], names=["x", "y", "count"])

    if not places:
        return spark.createDataFrame([], schema)
    made, at = None, 0
    while at < len(places):
        some, size = [], 0
        while at < len(places) and (reach or not some or size + places[at][1] <= _HANDED):
            some.append((*places[at], None if reach else source.read_at(*places[at])))
            size += places[at][1]
            at += 1
        part = spark.createDataFrame(some, "at long, size int, data binary").repartition(max(1, min(len(some), 1024))).mapInArrow(run, schema)
        if not reach and at < len(places):
            part = written(part)
        made = part if made is None else made.unionByName(part)
    (a1, z1), (a2, z2) = limits
    inside = F.col("x").between(a1, z1) & F.col("y").between(a2, z2)
    if c1 == c2:
        inside = inside | (F.col("x").between(a2, z2) & F.col("y").between(a1, z1))
    out = made.where(inside)
    return out.select(F.col("y").alias("x"), F.col("x").alias("y"), "count") if swapped else out
