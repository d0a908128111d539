"""BAM records made and read by whole columns, and scans of many small stretches."""

import random
import re
import struct
import sys

import numpy as np
import pyarrow as pa
import pytest
import test_bam

from ligaspark.sources import bam

REFS = {n: i for i, (n, _) in enumerate(test_bam.LENGTHS)}
TYPES = {c: pa.string() for c in ("read_id", "rname", "cigar", "next_rname", "seq", "qual")} | {c: pa.int64() for c in ("flag", "pos", "end_pos", "mapq", "next_pos", "template")}


def batch(rows):
    return pa.RecordBatch.from_pylist(rows, pa.schema(TYPES.items()))


def plain(r):
    """A record by the format's description, field by field."""
    name, cigar = (r["read_id"] or "*").encode(), r["cigar"]
    value = lambda c, none: none if r[c] is None else r[c]
    pos, flag = value("pos", -1), value("flag", 0)
    if cigar is None:
        cigar = f"{r['end_pos'] - pos}M" if r["end_pos"] is not None and not flag & 4 and r["end_pos"] > pos else "*"
    ops = [(int(n or 0), "MIDNSHP=X".index(o)) for n, o in re.findall(r"(\d*)([MIDNSHP=X])", cigar)]
    begin = max(pos, 0)
    end = begin + max(sum(n for n, o in ops if o in (0, 2, 3, 7, 8)), 1) - 1
    where = next((((1 << (29 - s)) - 1) // 7 + (begin >> s) for s in (14, 17, 20, 23, 26) if begin >> s == end >> s), 0)
    seq = "" if r["seq"] in (None, "*") else r["seq"].upper()
    codes = [max("=ACMGRSVTWYHKDBN".find(c), 0) if c in "=ACMGRSVTWYHKDBN" else 15 for c in seq] + [0] * (len(seq) % 2)
    qual = b"\xff" * len(seq) if r["qual"] in (None, "*") else bytes(max(ord(c) - 33, 0) for c in r["qual"])
    fixed = REFS.get(r["rname"], -1), pos, len(name) + 1, value("mapq", 255), where & 0xFFFF, len(ops), flag, len(seq), REFS.get(r["next_rname"], -1), value("next_pos", -1), value("template", 0)
    body = struct.pack("<iiBBHHHiiii", *fixed) + name + b"\0" + b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + qual
    return struct.pack("<i", len(body)) + body


def odd_rows(n, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        seq = rng.choice([None, "*", "", "A", "".join(rng.choice("ACGTNacgtnMRWSYK=xé.") for _ in range(rng.randint(2, 150)))])
        k = 0 if seq in (None, "*") else len(seq)
        out.append({
            "read_id": rng.choice([None, "", "*", f"r{i}", "ü" * 5, "x" * 254]), "flag": rng.choice([None, 0, 4, 16, 65_535]), "rname": rng.choice([None, "*", "chr1", "scaffold_1"]),
            "pos": rng.choice([None, -1, 0, 16_380, (1 << 26) - 1, 1 << 29, 2_000_000_000]), "end_pos": rng.choice([None, -1, 3, 16_390]), "mapq": rng.choice([None, 0, 255]),
            "cigar": rng.choice([None, "*", "", "5M", "M", "007M", "268435455N", "3", "5M3", f"{k}M3I0D12N9S1H2P4=5X"]), "next_rname": rng.choice([None, "*", "chr2"]), "next_pos": rng.choice([None, -1, 77]),
            "template": rng.choice([None, -5, 2**31 - 1]), "seq": seq, "qual": rng.choice([None, "*", "".join(chr(rng.randint(33, 126)) for _ in range(k)), "".join(chr(rng.randint(20, 255)) for _ in range(k))]),
        })
        if out[-1]["qual"] == "*" and k == 1:
            out[-1]["qual"] = None
    return out


def test_records_as_the_format_has_them(monkeypatch):
    rows = odd_rows(3_000)
    want = list(map(plain, rows))
    assert bam.encode(batch(rows), REFS).to_pylist() == want
    assert bam.encode(batch(rows).slice(777, 500), REFS).to_pylist() == want[777:1_277]
    monkeypatch.setattr(bam, "_TOGETHER", 10_000)
    parts = list(bam._portions(iter([batch(rows), batch([])])))
    assert len(parts) > 10 and [x for p in parts for x in bam.encode(p, REFS).to_pylist()] == want


@pytest.mark.parametrize("bad", [{"cigar": "5Q"}, {"cigar": "268435456M"}, {"cigar": "1M" * 70_000}, {"flag": 70_000}, {"mapq": -1}, {"pos": 1 << 31}, {"seq": "Ā"}, {"seq": "AC", "qual": "I"}, {"rname": "chrX"}, {"read_id": "n" * 255}])
def test_what_the_format_cannot_hold(bad):
    with pytest.raises((ValueError, KeyError)):
        bam.encode(batch([{c: None for c in TYPES} | bad]), REFS)


def calls(run):
    """How many functions a run calls, those of C included."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        run()
    finally:
        sys.setprofile(None)
    return n


def test_records_are_not_made_or_told_one_by_one():
    rows = [{c: None for c in TYPES} | {"read_id": f"r{i}", "rname": "chr1", "pos": i, "cigar": "5S12M2I3M1D2N9S", "seq": "ACGTN" * 7, "qual": "IIIII" * 7} for i in range(4_000)]
    few, many = batch(rows[:40]), batch(rows)
    assert calls(lambda: bam.encode(many, REFS)) < 2 * calls(lambda: bam.encode(few, REFS))
    told = []
    for b in (few, many):
        data, lengths = bam._bytes(bam.encode(b, REFS))
        told.append(calls(lambda d=data.tobytes(), n=lengths: bam.decode(d, np.cumsum(n) - n, list(REFS), list(bam._NAMES))))
    assert told[1] < 2 * told[0]


def test_blocks_hold_as_many_records_as_fit(monkeypatch):
    monkeypatch.setattr(bam.bgzf, "LARGEST", 100)
    monkeypatch.setattr(bam.bgzf, "member", lambda data, level: bytes(data) + b"|")
    sizes = [40, 60, 1, 99, 1, 250, 30, 100, 100, 3]
    for cut in range(len(sizes) + 1):
        out, held = [], b""
        for part in (sizes[:cut], sizes[cut:]):
            if part:
                held = bam._blocks(type("Out", (), {"write": staticmethod(out.append)}), held, pa.array([b"x" * n for n in part], pa.large_binary()), 6)
        assert [len(x) - 1 for x in out] + [len(held)] == [100, 100, 1, 100, 100, 50, 30, 100, 100, 3]


def test_many_stretches_are_some_tasks(tmp_path, monkeypatch):
    rs = test_bam.rows(3_000)
    for k in range(2):
        (tmp_path / f"{k}.bam").write_bytes(test_bam.spanning(rs[k::2], 0, 500))
    reader = bam.BamReader(str(tmp_path), list(bam._NAMES), 211)
    tasks = reader.partitions()
    stretches = [(s.path, s.start, s.end) for t in tasks for s in t.stretches]
    assert stretches == bam.stores.splits(str(tmp_path), 211) and len(stretches) > 600 and 128 < len(tasks) <= 257
    assert sorted(tuple(r.values()) for t in tasks for b in reader.read(t) for r in b.to_pylist()) == test_bam.expected(rs)
    monkeypatch.setattr(bam, "SPLIT_BYTES", 211)  # what a task reads at most
    assert [len(t.stretches) for t in reader.partitions()].count(1) > 600


def test_first_records_by_little(tmp_path, monkeypatch):
    monkeypatch.setattr(bam, "_LOOK", 64)
    test_bam.test_records_over_blocks(tmp_path, 3_000, 120)
