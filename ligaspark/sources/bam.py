"""BAM as a data source of Spark: ``spark.read.format("bam")`` plans tasks over stretches of files, ``df.write.format("bam")`` writes a file per task.

Layout and field meanings are those of the public SAM/BAM specification. A stretch begins anywhere; its task looks for the first block in it, and in the blocks
for the first record, as records may go on over blocks. A place is a record if its fixed fields are possible for the header's references, and so are those of the
records that follow it. A record belongs to the stretch in which the block where it begins begins, so each is read once. Positions are 0-based, ends
exclusive; what is absent is ``*``, as in SAM text, and a missing position is -1.

A schema with fewer columns (``.schema("read_id string, pos long")``) decodes those only. Option ``split_bytes`` is the size of a stretch; of many small ones a task reads several. The writer needs
``lengths``, JSON of [[name, length], ...]; rows need ``read_id``, ``flag``, ``rname``, ``pos``, ``mapq``; a ``cigar`` that is absent is a match from ``pos`` to ``end_pos``, other
columns may be absent. Null positions and references are missing ones, a null quality is 255, null texts are absent; a name of more than 254 letters or a reference that
the header has not is an error. Tags of records are skipped. Files become visible when all tasks have ended; what failed tasks wrote is removed, and stays hidden where a task outlives its job. No rows make files
with a header alone, which read as no rows; a folder without files cannot be read, as its header is not known.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import bgzf, stores

SCHEMA = "read_id string, flag int, rname string, pos long, end_pos long, mapq int, cigar string, next_rname string, next_pos long, template int, seq string, qual string"
_NAMES = tuple(f.split()[0] for f in SCHEMA.split(", "))
#: Fixed values of the format: letters of CIGAR operations and of bases by number, and which operations move on in the reference.
CIGAR_OPS, BASES, ON_REFERENCE = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", (0, 2, 3, 7, 8)
_FIXED = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("next", "<i4"), ("next_pos", "<i4"), ("template", "<i4")])
SPLIT_BYTES = 32 << 20
_TASKS = 256  # a scan of more tasks gives each several stretches, up to SPLIT_BYTES
_GROUP = 4 << 20  # inflated bytes that are decoded together
_LOOK = 1 << 16  # inflated bytes that are searched for a record at first
_SURE = 16  # records in a row that have to be possible
_LONGEST = 1 << 28  # bytes of a record


@dataclass
class Header:
    text: str
    names: list[str]
    lengths: list[int]
    block: int  # where the first record begins: the block, and the place in it
    offset: int


def read_header(path: str) -> Header:
    store, at = stores.opened(path)
    with store.open_input_file(at) as f:
        data, ends = b"", []
        for start, block in bgzf.blocks(f, 0):
            ends.append((start, len(data)))
            data += block
            found = _header(data)
            if found:
                text, names, lengths, stop = found
                b, base = max((e for e in ends if e[1] <= stop), key=lambda e: e[1])
                return Header(text, names, lengths, b, stop - base)
    raise ValueError(f"{path} is no BAM file")


def _header(data: bytes) -> tuple | None:
    """(text, names, lengths, end) if the data holds the whole header."""
    if data[:4] not in (b"BAM\x01", b"BAM", b"BA", b"B", b""):
        raise ValueError("no BAM file")
    try:
        (n,) = struct.unpack_from("<i", data, 4)
        text = data[8 : 8 + n].rstrip(b"\0").decode()
        (k,) = struct.unpack_from("<i", data, 8 + n)
        at, names, lengths = 12 + n, [], []
        for _ in range(k):
            (m,) = struct.unpack_from("<i", data, at)
            (long,) = struct.unpack_from("<i", data, at + 4 + m)
            names.append(data[at + 4 : at + 3 + m].decode())
            lengths.append(long)
            at += 8 + m
        return text, names, lengths, at
    except struct.error:
        return None


# ---------------------------------------------------------------- records


def possible_starts(data: np.ndarray, n_refs: int) -> np.ndarray:
    """Places at which the fixed fields and the name of a record could stand."""
    n = len(data) - 36
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    wide = data.astype(np.uint32)
    two = wide[:-1] | wide[1:] << 8
    four = (two[:-2] | two[2:] << 16).view(np.int32)
    at = lambda k: four[k : k + n]
    name, ops, bases = wide[12 : 12 + n], two[16 : 16 + n], at(20)
    ok = (at(4) >= -1) & (at(4) < n_refs) & (at(24) >= -1) & (at(24) < n_refs) & (at(8) >= -1) & (at(28) >= -1) & (name >= 1) & (bases >= 0)
    where = np.flatnonzero(ok)
    b = bases[where].astype(np.int64)
    least = 32 + name[where].astype(np.int64) + 4 * ops[where].astype(np.int64) + (b + 1) // 2 + b
    size = at(0)[where].astype(np.int64)
    where = where[(size >= least) & (size < _LONGEST)]
    end = where + 35 + name[where].astype(np.int64)
    inside = end < len(data)
    return where[~inside | (data[np.minimum(end, len(data) - 1)] == 0)]


def first_record(data: bytes, n_refs: int, whole: bool) -> int | None:
    """Where the first record begins in inflated data that begins anywhere: the first place from which ``_SURE`` records, or all up to the end of the file, are
    possible. None if there is none; -1 if the data, unless it is all there is (``whole``), is too little to tell."""
    look = _LOOK
    while look < len(data):  # most often the first few are enough
        found = first_record(data[:look], n_refs, False)
        if found is not None and found >= 0:
            return found
        look *= 4
    starts = possible_starts(np.frombuffer(data, np.uint8), n_refs)
    good = set(starts.tolist())
    last = len(data) - 37  # places after it cannot be told
    for s in starts.tolist():
        at, n = s, 0
        while at in good and n < _SURE:
            n += 1
            at += 4 + struct.unpack_from("<i", data, at)[0]
        if n >= _SURE or (whole and at == len(data)):
            return s
        if at > last and not whole:
            return -1
    return None


def _binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _stretches(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
    return _binaries(data[at], lengths)


def _strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Stretches of bytes as strings."""
    return _stretches(data, starts, lengths).cast(pa.string())


def _cigars(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """CIGAR texts, and how far each goes on in the reference; equal ones are told once."""
    found = _stretches(data, at, 4 * n).dictionary_encode()
    texts, spans = [], []
    for raw in found.dictionary.to_pylist():
        ops = [(v >> 4, v & 15) for v in struct.unpack(f"<{len(raw) // 4}I", raw)]
        texts.append("".join(f"{m}{CIGAR_OPS[o]}" for m, o in ops) or "*")
        spans.append(sum(m for m, o in ops if o in ON_REFERENCE))
    return pa.array(texts, pa.string()).take(found.indices), np.array(spans, np.int64)[found.indices.to_numpy()]


def decode(data: bytes, starts: np.ndarray, names: list[str], wanted: list[str]) -> pa.RecordBatch:
    """The wanted columns of the records that begin at ``starts``."""
    arr = np.frombuffer(data, np.uint8)
    fixed = arr[starts[:, None] + np.arange(36)].copy().view(_FIXED).reshape(-1)
    name, ops, bases = (fixed[c].astype(np.int64) for c in ("name", "ops", "bases"))
    at_ops = starts + 36 + name
    at_bases = at_ops + 4 * ops
    at_quals = at_bases + (bases + 1) // 2
    known = np.array([*names, "*"], dtype=object)
    out = {}
    if "cigar" in wanted or "end_pos" in wanted:
        texts, spans = _cigars(arr, at_ops, ops)
        out["cigar"], out["end_pos"] = texts, pa.array(fixed["pos"] + spans, pa.int64())
    if "seq" in wanted:
        letters = np.frombuffer(BASES.encode(), np.uint8)
        step = (bases + 1) // 2
        ends = np.concatenate([[0], np.cumsum(step)])
        packed = arr[np.repeat(at_bases - ends[:-1], step) + np.arange(ends[-1])]
        both = np.stack([letters[packed >> 4], letters[packed & 15]], axis=1).reshape(-1)
        out["seq"] = _stars(_strings(both, 2 * ends[:-1], bases), bases == 0)
    if "qual" in wanted:
        missing = (bases == 0) | (arr[np.minimum(at_quals, len(arr) - 1)] == 255)
        out["qual"] = _stars(_strings(np.minimum(arr, 93) + np.uint8(33), at_quals, np.where(missing, 0, bases)), missing)
    if "read_id" in wanted:
        out["read_id"] = _strings(arr, starts + 36, name - 1)
    for c, field in (("rname", "ref"), ("next_rname", "next")):
        if c in wanted:
            out[c] = pa.array(known[fixed[field]], pa.string())
    for c, field, kind in (("flag", "flag", pa.int32()), ("mapq", "mapq", pa.int32()), ("pos", "pos", pa.int64()), ("next_pos", "next_pos", pa.int64()), ("template", "template", pa.int32())):
        if c in wanted:
            out[c] = pa.array(fixed[field].astype(np.int64), kind)
    return pa.RecordBatch.from_arrays([out[c] for c in wanted], names=wanted)


def _stars(texts: pa.Array, where: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(where), "*", texts) if where.any() else texts


# ---------------------------------------------------------------- reading


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int
    header: Header


@dataclass
class Stretches(InputPartition):
    """What a task reads, one after another: a task costs as much as some megabytes."""

    stretches: list[Stretch]


def records(p: Stretch, wanted: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of the records that begin in a stretch."""
    store, inside = stores.opened(p.path)
    size_at = struct.Struct("<i").unpack_from
    with store.open_input_file(inside) as f:
        block, skip = (p.header.block, p.header.offset) if p.start <= p.header.block < p.end else (None, None)
        if block is None:
            block = bgzf.first_block(f, max(p.start, p.header.block), p.end) if p.end > p.header.block else None
        if block is None:
            return
        source = bgzf.blocks(f, block)
        held, own, sure, more = b"", 0, skip is not None, True  # inflated data, how much of it is in own blocks, whether a record begins at its start
        if sure:
            _, first = next(source)
            held = first[skip:]
            own = len(held)
        while True:
            part, mine = [held], own
            size = len(held)
            while more and size < _GROUP + len(held) and mine == size:
                got = next(source, None)
                if got is None:
                    more = False
                else:
                    part.append(got[1])
                    size += len(got[1])
                    mine += len(got[1]) if got[0] < p.end else 0
            ended = not more or mine < size
            data = b"".join(part)
            if not sure:
                at = -1
                while at == -1:  # enough beyond the end to tell a record by those after it
                    size = 2 * len(data)
                    while more and ended and (at == -1 and len(data) < size or len(data) < mine + 36):
                        got = next(source, None)
                        more = got is not None
                        data += got[1] if got else b""
                    at = first_record(data, len(p.header.names), not more)
                    if at == -1 and not ended:
                        at = None
                if at is None or at >= mine:
                    if ended:
                        return
                    held, own = data, mine
                    continue
                data, mine, sure = data[at:], mine - at, True
            starts, at, n = [], 0, len(data)
            while at < mine and at + 4 <= n and (stop := at + 4 + size_at(data, at)[0]) <= n:  # most records are all there
                starts.append(at)
                at = stop
            while at < mine:
                if len(data) < at + 4 and not ended:
                    break
                while more and len(data) < at + 4:
                    got = next(source, None)
                    more = got is not None
                    data += got[1] if got else b""
                if len(data) < at + 4:
                    raise ValueError(f"{p.path} is cut off inside of a record")
                stop = at + 4 + struct.unpack_from("<i", data, at)[0]
                if stop > len(data):
                    if not ended:
                        break
                    while more and len(data) < stop:
                        got = next(source, None)
                        more = got is not None
                        data += got[1] if got else b""
                    if stop > len(data):
                        raise ValueError(f"{p.path} is cut off inside of a record")
                starts.append(at)
                at = stop
            if starts:
                yield decode(data, np.array(starts, dtype=np.int64), p.header.names, wanted)
            if ended and at >= mine:
                return
            held, own = data[at:], mine - at


class BamReader(DataSourceReader):
    def __init__(self, path: str, wanted: list[str], split: int):
        self.path, self.wanted, self.split = path, wanted, split

    def partitions(self) -> list[Stretches]:
        splits, headers, out, size = stores.splits(self.path, self.split), {}, [], 0
        least = min(SPLIT_BYTES, sum(z - a for _, a, z in splits) // _TASKS)
        for path, a, z in splits:
            if path not in headers:
                headers[path] = read_header(path)
            if not out or size >= least:
                out.append(Stretches([]))
                size = 0
            out[-1].stretches.append(Stretch(path, a, z, headers[path]))
            size += z - a
        return out

    def read(self, partition: Stretches) -> Iterator[pa.RecordBatch]:
        for p in partition.stretches:
            yield from records(p, self.wanted)


# ---------------------------------------------------------------- writing


def header_bytes(lengths: list[tuple[str, int]], text: str | None = None) -> bytes:
    if text is None:
        text = "@HD\tVN:1.6\tSO:unknown\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in lengths)
    raw = text.encode()
    out = [b"BAM\x01", struct.pack("<i", len(raw)), raw, struct.pack("<i", len(lengths))]
    for name, n in lengths:
        out += [struct.pack("<i", len(name) + 1), name.encode() + b"\0", struct.pack("<i", n)]
    return b"".join(out)


def bin_of(start, end):
    """Numbers of the smallest bins of the format's index that hold stretches: 1 + 8 + 64 + ... bins of 512, 64, 8, 1 Mb, 128 and 16 kb."""
    out = np.zeros(np.shape(start), np.int64)
    for shift in (26, 23, 20, 17, 14):
        at = start >> shift
        out = np.where(at == (end - 1) >> shift, ((1 << (29 - shift)) - 1) // 7 + at, out)
    return out


_CODE = np.array([BASES.find(chr(c).upper()) if chr(c).upper() in BASES else 15 for c in range(256)], np.uint8)
_QUALITY = np.array([max(c - 33, 0) for c in range(256)], np.uint8)
_OPERATION = np.array([CIGAR_OPS.find(chr(c)) for c in range(256)], np.int64)
_TOGETHER = 16 << 20  # bytes of rows that are encoded together


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts of which none is null, one after another, and the texts' lengths."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def _text(v: str | None) -> pa.Scalar:
    return pa.scalar(v, pa.large_string())


def _raw(v: bytes) -> pa.Scalar:
    return pa.scalar(v, pa.large_binary())


def _letters(texts: pa.Array) -> pa.Array:
    """Texts with a byte for each letter; an absent one is null."""
    texts = pc.replace_with_mask(texts, pc.fill_null(pc.equal(texts, _text("*")), False), _text(None))  # if_else puts nulls at wrong places of sliced texts
    if pc.all(pc.string_is_ascii(texts)).as_py() is False:
        return pa.array([v and v.encode("latin-1") for v in texts.to_pylist()], pa.large_binary())
    return texts.cast(pa.large_binary())


def _operations(cigars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Operations of CIGAR texts as the format's numbers, one after another, how many each text has, and how far it goes on in the reference."""
    data, lengths = _bytes(pc.if_else(pc.equal(cigars, _text("*")), _text(""), cigars))
    at = np.flatnonzero((data < 48) | (data > 57))  # letters of operations
    op = _OPERATION[data[at]]
    if (op < 0).any():
        raise ValueError(f"no operation of a CIGAR: {chr(data[at][op < 0][0])}")
    ends = np.cumsum(lengths)
    row = np.searchsorted(ends, at, "right")
    digits = at - np.maximum((ends - lengths)[row], np.concatenate([[0], at[:-1] + 1])[: len(at)])
    number = np.zeros(len(at))
    for k in range(digits.max(initial=0)):
        more = np.flatnonzero(digits > k)
        number[more] += (data[at[more] - 1 - k] - 48.0) * 10.0**k
    if (number >= 1 << 28).any():
        raise ValueError(f"an operation of {number.max():.0f} letters")
    spans = np.bincount(row, number * np.isin(op, ON_REFERENCE), len(lengths)).astype(np.int64)
    return (number.astype(np.int64) << 4 | op).astype("<u4"), np.bincount(row, minlength=len(lengths)), spans


def encode(batch: pa.RecordBatch, refs: dict[str, int]) -> pa.Array:
    """The records of rows, each with its size before it; whole columns at a time."""
    n = batch.num_rows
    column = lambda c, kind: batch.column(c).cast(kind) if c in batch.schema.names else pa.nulls(n, kind)
    whole = lambda c, none: pc.fill_null(column(c, pa.int64()), none).to_numpy(zero_copy_only=False)

    def ref(c: str) -> np.ndarray:
        found = column(c, pa.large_string()).dictionary_encode()
        numbers = [-1 if v == "*" else refs[v] for v in found.dictionary.to_pylist()]
        return np.array([*numbers, -1])[pc.fill_null(found.indices, len(numbers)).to_numpy(zero_copy_only=False)]

    name = pc.fill_null(column("read_id", pa.large_string()), _text("*"))
    name = pc.if_else(pc.equal(name, _text("")), _text("*"), name).cast(pa.large_binary())
    n_name = _bytes(name)[1]
    if n_name.max() > 254:
        raise ValueError(f"a read's name has {n_name.max()} letters")
    flag, pos, end = whole("flag", 0), whole("pos", -1), whole("end_pos", -1)
    matched = (flag & 4 == 0) & (end > pos) & column("end_pos", pa.int64()).is_valid().to_numpy(zero_copy_only=False)
    made = pc.if_else(pa.array(matched), pc.binary_join_element_wise(pa.array(end - pos).cast(pa.large_string()), _text("M"), _text("")), _text("*"))
    ops, n_ops, span = _operations(pc.coalesce(column("cigar", pa.large_string()), made))
    seq, qual = pc.fill_null(_letters(column("seq", pa.large_string())), _raw(b"")), _letters(column("qual", pa.large_string()))
    bases = _bytes(seq)[1]
    given = qual.is_valid()
    wrong = np.flatnonzero(given.to_numpy(zero_copy_only=False) & (pc.fill_null(pc.binary_length(qual), 0).to_numpy(zero_copy_only=False) != bases))
    if len(wrong):
        k = int(wrong[0])
        raise ValueError(f"{name[k].as_py().decode()}: {bases[k]} bases, {len(qual[k].as_py())} qualities")
    codes = _CODE[_bytes(pc.binary_join_element_wise(seq, pc.if_else(pa.array(bases % 2 == 1), _raw(b"="), _raw(b"")), _raw(b"")))[0]]
    told, n_told = _bytes(pc.fill_null(qual, _raw(b"")))
    qual = pc.if_else(given, _binaries(_QUALITY[told], n_told), pc.binary_repeat(_raw(b"\xff"), pa.array(bases)))
    begin = np.maximum(pos, 0)
    values = {
        "size": 33 + n_name + 4 * n_ops + (bases + 1) // 2 + bases, "ref": ref("rname"), "pos": pos, "name": n_name + 1, "mapq": whole("mapq", 255), "bin": bin_of(begin, begin + np.maximum(span, 1)) & 0xFFFF, "ops": n_ops,
        "flag": flag, "bases": bases, "next": ref("next_rname"), "next_pos": whole("next_pos", -1), "template": whole("template", 0),
    }
    fixed = np.zeros(n, _FIXED)
    for c, v in values.items():
        limits = np.iinfo(_FIXED[c])
        if v.min() < limits.min or v.max() > limits.max:
            raise ValueError(f"{c} of a record from {v.min()} to {v.max()}")
        fixed[c] = v
    parts = _binaries(fixed.view(np.uint8), np.full(n, _FIXED.itemsize)), name, _raw(b"\0"), _binaries(ops.view(np.uint8), 4 * n_ops), _binaries(codes[::2] << 4 | codes[1::2], (bases + 1) // 2), qual
    return pc.binary_join_element_wise(*parts, _raw(b""))


def record_bytes(row: dict, refs: dict[str, int]) -> bytes:
    return encode(pa.RecordBatch.from_pylist([row]), refs)[0].as_py()


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``_TOGETHER`` bytes at most."""
    for batch in batches:
        n = max(1, batch.num_rows * _TOGETHER // max(batch.nbytes, _TOGETHER))
        for a in range(0, batch.num_rows, n):
            yield batch.slice(a, n)


@dataclass
class Written(WriterCommitMessage):
    part: str
    final: str


class BamWriter(DataSourceArrowWriter):
    def __init__(self, path: str, lengths: list[tuple[str, int]], level: int, overwrite: bool):
        self.path, self.lengths, self.level, self.overwrite, self.run = path, lengths, level, overwrite, uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, folder = stores.opened(self.path)
        k = TaskContext.get().partitionId()
        part, final = f"{folder}/_part-{self.run}-{k:05}-{uuid.uuid4().hex}", f"{folder}/part-{k:05}-{self.run}.bam"
        refs = {n: i for i, (n, _) in enumerate(self.lengths)}
        store.create_dir(folder, recursive=True)
        try:
            with store.open_output_stream(part) as out:
                head = header_bytes(self.lengths)
                for a in range(0, len(head), bgzf.LARGEST):
                    out.write(bgzf.member(head[a : a + bgzf.LARGEST], self.level))
                held = b""
                for batch in _portions(iterator):
                    held = _blocks(out, held, encode(batch, refs), self.level)
                _flush(out, held, self.level)
                out.write(bgzf.END)
        except BaseException:
            store.delete_file(part)
            raise
        return Written(part, final)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = stores.opened(self.path)
        done = [m for m in messages if m]
        if self.overwrite:
            keep = {m.part for m in done}
            for p, _, _ in stores.files(self.path) if done else []:
                if stores.opened(p)[1] not in keep:
                    store.delete_file(stores.opened(p)[1])
        for m in done:
            store.move(m.part, m.final)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, folder = stores.opened(self.path)
        for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if i.base_name.startswith(f"_part-{self.run}-"):
                store.delete_file(i.path)


def _blocks(out, held: bytes, records: pa.Array, level: int) -> bytes:
    """Write ``held`` and records in blocks, of which the last, as more may fit into it, is given back. Records begin in a new block where they fit into one."""
    data, lengths = _bytes(records)
    data, ends = memoryview(held + data.tobytes()), np.cumsum([len(held), *lengths]) if held else np.cumsum(lengths)
    start = k = 0
    while (k := max(k + 1, int(np.searchsorted(ends, start + bgzf.LARGEST, "right")))) < len(ends):
        _flush(out, data[start : ends[k - 1]], level)
        start = int(ends[k - 1])
    return bytes(data[start:])


def _flush(out, data: bytes, level: int) -> None:
    for a in range(0, len(data), bgzf.LARGEST):
        out.write(bgzf.member(data[a : a + bgzf.LARGEST], level))


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> BamReader:
        unknown = [n for n in schema.names if n not in _NAMES]
        if unknown:
            raise ValueError(f"no columns of alignments: {unknown}")
        return BamReader(self.options["path"], schema.names, int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], [tuple(x) for x in json.loads(self.options["lengths"])], int(self.options.get("level", 6)), overwrite)


def read_bam(spark: SparkSession, path: str, columns: str = SCHEMA, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Alignments of a BAM file or a folder of them; ``columns`` are the fields of ``SCHEMA`` that are wanted."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").schema(columns).option("split_bytes", split_bytes).load(path)


def write_bam(df: DataFrame, path: str, lengths: list[tuple[str, int]], level: int = 6) -> None:
    """Alignments as a folder of BAM files, one per task."""
    df.sparkSession.dataSource.register(BamSource)
    df.write.format("bam").option("lengths", json.dumps(lengths)).option("level", level).mode("overwrite").save(path)
