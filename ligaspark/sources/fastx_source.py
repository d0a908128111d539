"""FASTQ and FASTA as data sources of Spark, batch and stream: ``spark.read.format("fastq")`` plans a task for each stretch of a file and reads it once.

A line belongs to the stretch that holds the line break before it (the first line to the first stretch), so a task drops what comes before its first break, and
reads on beyond its end to finish a record. In FASTQ a task finds the first header by the mark of the third line: a line that begins with ``@`` is a header if the
second one after it begins with ``+``, as no sequence does. Plain files and blocked gzip (bgzip) are cut at every ``split_bytes``; other gzip files are one task each, as
they cannot be entered.

``fastq``: (file, part, nth, seqid, seq, quality): a record's place is the start of its stretch and its number there, so (file, part, nth) sorts as the files do.
Identifiers are the header's first word without its mark; a trailing partial record is dropped. ``fasta``: (file, part, nth, name, seq): pieces of at most
``piece`` letters, ``name`` only on a record's first one, null on those that go on; see :func:`read_pieces` for their places. As streams both give the
files that have arrived since, by time of change and name. White space at the ends of lines goes. Empty files have no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import written
from . import bgzf, stores

FASTQ = "file string, part long, nth long, seqid string, seq string, quality string"
FASTA = "file string, part long, nth long, name string, seq string"
SPLIT_BYTES, PIECE = 32 << 20, 1 << 20
_CHUNK = 4 << 20


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int
    kind: str  # plain, blocked or gzip


def plan(files: list[tuple[str, int, int]], split: int) -> list[Stretch]:
    out = []
    for path, size, _ in files:
        store, at = stores.opened(path)
        with store.open_input_file(at) as f:
            head = f.read(64)
        kind = "plain" if head[:2] != b"\x1f\x8b" else "blocked" if bgzf.is_blocked(head) else "gzip"
        out += [Stretch(path, a, min(a + split, size), kind) for a in range(0, size, split if kind != "gzip" else size)]
    return out


def chunks(p: Stretch) -> Iterator[tuple[bytes, bool]]:
    """The content from a stretch's start to the end of the file, and whether it is the stretch's own or comes after it."""
    store, inside = stores.opened(p.path)
    with store.open_input_file(inside) as f:
        if p.kind == "gzip":
            d = zlib.decompressobj(31)
            while raw := f.read(_CHUNK):
                while raw:
                    data = d.decompress(raw, _CHUNK)
                    if data:
                        yield data, True
                    raw = d.unconsumed_tail
                    if d.eof:  # members one after another
                        raw, d = d.unused_data, zlib.decompressobj(31)
        elif p.kind == "blocked":
            first = bgzf.first_block(f, p.start, p.end)
            for at, data in bgzf.blocks(f, first) if first is not None else ():
                yield data, at < p.end
        else:
            f.seek(p.start)
            at = p.start
            while raw := f.read(min(_CHUNK, p.end - at) if at < p.end else 1 << 16):
                yield raw, at < p.end
                at += len(raw)


class Lines:
    """Lines of a stretch, group by group: ``data``, the starts of its complete lines with one more place after the last, and how many of them are the stretch's own."""

    def __init__(self, p: Stretch):
        self.source, self.first = chunks(p), p.start == 0
        self.data, self.mine, self.over, self.done = b"", 0, False, False

    def more(self) -> bool:
        got = next(self.source, None)
        if got is None:
            if not self.done and self.data and not self.data.endswith(b"\n"):
                self.data += b"\n"  # the last line has no break
            self.done = True
            return False
        self.data += got[0]
        if got[1]:
            self.mine = len(self.data)
        else:
            self.over = True
        return True

    def begin(self) -> bool:
        """Skips to the first line of the stretch's own."""
        if self.first:
            return self.more()
        while (at := self.data.find(b"\n", 0, self.mine)) < 0:
            if self.over or not self.more():
                return False
        self.drop(at + 1)
        return True

    def fill(self) -> None:
        """About a chunk of own content, and nothing beyond."""
        size = len(self.data) + _CHUNK
        while not self.over and not self.done and len(self.data) < size:
            self.more()

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero(np.frombuffer(self.data, np.uint8) == 10) + 1])

    def drop(self, n: int) -> None:
        self.data, self.mine = self.data[n:], self.mine - n


def _texts(data: bytes, a: np.ndarray, z: np.ndarray) -> pa.Array:
    """Stretches of bytes as strings without white space at their ends."""
    arr, n = np.frombuffer(data, np.uint8), z - a
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(a - ends[:-1], n) + np.arange(ends[-1])
    return pc.utf8_rtrim_whitespace(pa.LargeStringArray.from_buffers(len(a), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(arr[at].tobytes())).cast(pa.string()))


def _batch(p: Stretch, nth: int, columns: dict, wanted: list[str]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns |= {"file": pa.array([p.path] * n, pa.string()), "part": pa.array(np.full(n, p.start), pa.int64()), "nth": pa.array(np.arange(nth, nth + n), pa.int64())}
    return pa.RecordBatch.from_arrays([columns[c] for c in wanted], names=wanted)


def fastq_records(p: Stretch, wanted: list[str]) -> Iterator[pa.RecordBatch]:
    lines, nth = Lines(p), 0
    if not lines.begin():
        return
    if not lines.first:  # a header is among the first four lines; six tell which
        while len(at := lines.starts()) < 7 and lines.more():
            pass
        mark = lambda i: lines.data[at[i] : at[i] + 1] if i < len(at) else b""
        k = next((i for i in range(4) if mark(i) == b"@" and mark(i + 2) == b"+"), None)
        if k is None or at[k] > lines.mine:
            return
        lines.drop(int(at[k]))
    while True:
        lines.fill()
        while lines.over and not lines.done and len(lines.starts()) < 5:
            lines.more()
        at = lines.starts()
        n = (len(at) - 1) // 4
        heads = at[0 : 4 * n : 4]
        n = int(np.searchsorted(heads, lines.mine, side="right"))
        if n:
            a, z = at[: 4 * n].reshape(n, 4), at[1 : 4 * n + 1].reshape(n, 4) - 1
            columns = {c: _texts(lines.data, a[:, k], z[:, k]) for c, k in (("seq", 1), ("quality", 3)) if c in wanted}
            if "seqid" in wanted or not columns:
                columns["seqid"] = pc.replace_substring_regex(_texts(lines.data, a[:, 0], z[:, 0]), r"^@|\s.*", "")
            yield _batch(p, nth, columns, wanted)
            nth += n
            lines.drop(int(at[4 * n]))
        if lines.mine < 0 or (lines.done and n == 0) or (lines.over and len(at) - 1 >= 4 and n == 0):
            return


def fasta_pieces(p: Stretch, wanted: list[str], piece: int) -> Iterator[pa.RecordBatch]:
    """Every line is the stretch's own or not, so nothing is finished beyond its end but the line itself."""
    lines, nth = Lines(p), 0
    if not lines.begin():
        return
    name, held, size = None, [], 0
    rows: list[tuple] = []

    def flush(names, seqs):
        nonlocal nth
        out = _batch(p, nth, {"name": pa.array(names, pa.string()), "seq": pa.array(seqs, pa.string())}, wanted)
        nth += len(names)
        return out

    open_ = False
    while True:
        lines.fill()
        while lines.over and not lines.done and b"\n" not in lines.data:
            lines.more()
        at = lines.starts()
        own = int(np.searchsorted(at[:-1], lines.mine, side="right"))
        for a, z in zip(at[:own].tolist(), at[1 : own + 1].tolist(), strict=True):
            line = lines.data[a:z].decode().strip()
            if line.startswith(">"):
                if open_ or held:
                    rows.append((name, "".join(held)))
                name, held, size, open_ = line[1:], [], 0, True
                continue
            while size + len(line) > piece:
                held.append(line[: piece - size])
                rows.append((name, "".join(held)))
                line, name, held, size, open_ = line[piece - size :], None, [], 0, False
            held.append(line)
            size += len(line)
        if rows:
            yield flush([r[0] for r in rows], [r[1] for r in rows])
            rows = []
        if own:
            lines.drop(int(at[own]))
        if lines.mine < 0 or (not own and (lines.done or lines.over)):
            break
    if open_ or any(held):
        yield flush([name], ["".join(held)])


class Reader(DataSourceReader):
    def __init__(self, path: str, options: dict, wanted: list[str], rows):
        self.path, self.split, self.wanted, self.rows = path, int(options.get("split_bytes", SPLIT_BYTES)), wanted, rows

    def partitions(self) -> list[Stretch]:
        return plan(stores.files(self.path), self.split)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.rows(partition, self.wanted)


class StreamReader(DataSourceStreamReader):
    """Files by time of change and name; an offset is the last file that was seen."""

    def __init__(self, path: str, options: dict, wanted: list[str], rows):
        self.path, self.split, self.wanted, self.rows = path, int(options.get("split_bytes", SPLIT_BYTES)), wanted, rows

    def _files(self) -> list[tuple[str, int, int]]:
        return sorted(stores.files(self.path), key=lambda f: (f[2], f[0]))

    def initialOffset(self) -> dict:
        return {"time": -1, "file": ""}

    def latestOffset(self) -> dict:
        found = self._files()
        return {"time": found[-1][2], "file": found[-1][0]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        key = lambda o: (o["time"], o["file"])
        return plan([f for f in self._files() if key(start) < (f[2], f[0]) <= key(end)], self.split)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.rows(partition, self.wanted)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return FASTQ

    def _rows(self):
        return fastq_records

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(self.options["path"], dict(self.options), schema.names, self._rows())

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(self.options["path"], dict(self.options), schema.names, self._rows())


class FastaSource(FastqSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return FASTA

    def _rows(self):
        piece = int(self.options.get("piece", PIECE))
        return lambda p, wanted: fasta_pieces(p, wanted, piece)


def read_fastq(spark: SparkSession, path: str, columns: str = FASTQ, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Reads of a FASTQ file or folder, in one scan."""
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").schema(columns).option("split_bytes", split_bytes).load(path)


def stream_fastq(spark: SparkSession, path: str, columns: str = FASTQ, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Reads of the FASTQ files that arrive in a folder."""
    spark.dataSource.register(FastqSource)
    return spark.readStream.format("fastq").schema(columns).option("split_bytes", split_bytes).load(path)


def read_pieces(spark: SparkSession, path: str, piece: int = PIECE, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(record, name, start, seq): pieces of FASTA sequences with their record's number and name and their place in it: all of ``piece`` letters but a record's last,
    wherever stretches begin; one of no letters for a record without any.

    The pieces are written once; their places are sums over their lengths alone, first within stretches and then over the stretches' totals, so no task holds
    more than the numbers of one stretch's pieces or of one file's stretches. Where a record goes on from one stretch to the next, its pieces in the later one, and the
    last in the earlier one, are cut anew at multiples of ``piece`` and joined; no others are moved. Lines before the first header of a file are dropped.
    """
    spark.dataSource.register(FastaSource)
    pieces = written(spark.read.format("fasta").option("piece", piece).option("split_bytes", split_bytes).load(path).withColumn("n", F.length("seq")))
    light = pieces.select("file", "part", "nth", "name", "n")
    upto = Window.partitionBy("file", "part").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.col("name").isNotNull()
    light = light.withColumn("k", F.count_if(begins).over(upto)).withColumn("z", F.sum("n").over(upto))
    light = light.withColumn("begun", F.last(F.when(begins, F.struct("name", (F.col("z") - F.col("n")).alias("at"))), True).over(upto))
    parts = light.groupBy("file", "part").agg(F.max("k").alias("k"), F.max("z").alias("z"), F.max("nth").alias("last"), F.max_by("begun", "nth").alias("begun"))
    # of the parts before: how many records, how many letters, and the last record's name and the place where it begins, counted from the file's first letter
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    parts = parts.withColumn("k0", zero(F.sum("k").over(before))).withColumn("z0", zero(F.sum("z").over(before)))
    parts = parts.withColumn("open", F.when(F.col("begun").isNotNull(), F.struct(F.col("begun.name").alias("name"), (F.col("begun.at") + F.col("z0")).alias("at"))))
    parts = parts.select("file", "part", "k0", "z0", "last", F.last("open", True).over(before).alias("open"))
    placed = light.join(parts, ["file", "part"]).withColumn("own", F.when(F.col("begun").isNotNull(), F.struct(F.col("begun.name").alias("name"), (F.col("begun.at") + F.col("z0")).alias("at"))).otherwise(F.col("open")))
    placed = placed.where("own is not null and (n > 0 or name is not null)")
    # only a stretch's last piece, and those of a record that began before it, can have been cut at other places than multiples of ``piece``
    edge = (F.col("k") == 0) | (F.col("nth") == F.col("last"))
    placed = placed.select("file", "part", "nth", (F.col("k0") + F.col("k")).alias("record"), F.col("own.name").alias("name"), (F.col("z0") + F.col("z") - F.col("n") - F.col("own.at")).alias("start"), edge.alias("edge"))
    placed = written(placed)
    texts = pieces.select("file", "part", "nth", "seq")
    columns = ["file", "record", "name", "start", "seq"]
    inner = placed.where("not edge").join(texts, ["file", "part", "nth"]).select(*columns)
    first, after = F.expr(f"start div {piece}"), F.expr(f"(start + greatest(length(seq), 1) - 1) div {piece}")
    cut = placed.where("edge").join(texts, ["file", "part", "nth"]).select(*columns, F.explode(F.sequence(first, after)).alias("b"))
    a = F.greatest(F.col("b") * piece - F.col("start"), F.lit(0))  # where block b begins in the piece
    z = F.least((F.col("b") + 1) * piece - F.col("start"), F.length("seq"))
    cut = cut.select("file", "record", "name", "b", F.struct((F.col("start") + a).alias("at"), F.substring("seq", (a + 1).cast("int"), (z - a).cast("int")).alias("seq")).alias("x"))
    whole = cut.groupBy("file", "record", "name", "b").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["seq"]), "").alias("seq"))  # a piece in all
    return inner.unionByName(whole.select("file", "record", "name", (F.col("b") * piece).alias("start"), "seq"))
