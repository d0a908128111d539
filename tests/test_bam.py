"""BAM: blocks, records that begin anywhere, round trips, and what fails."""

import random
import struct

import numpy as np
import pytest

from ligaspark.sources import bam, bgzf

LENGTHS = [("chr1", 1_000_000), ("chr2", 500_000), ("scaffold_1", 900)]


def rows(n, seed=1, longest=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = rng.choice([0, 1, rng.randint(2, longest)])
        seq = "".join(rng.choice("ACGTNMRWSYK=") for _ in range(k)) or None
        lost = rng.random() < 0.2
        cigar = "*" if lost or not k else f"{k}M" if k < 3 else f"1S{k - 2}M1I3D2N"
        out.append((f"read/{i}:{'x' * rng.randint(0, 40)}", 4 if lost else rng.choice([0, 16, 99, 2048]), "*" if lost else rng.choice(LENGTHS)[0], -1 if lost else rng.randint(0, 800), rng.randint(0, 255), cigar, rng.choice(["*", "chr2"]), rng.randint(-1, 500), rng.randint(-999, 999), seq, None if seq is None or rng.random() < 0.2 else "".join(chr(rng.randint(33, 126)) for _ in range(k))))
    return out


SCHEMA = "read_id string, flag int, rname string, pos long, mapq int, cigar string, next_rname string, next_pos long, template int, seq string, qual string"


def expected(rs):
    import re

    def one(r):
        span = sum(int(n) for n, o in re.findall(r"(\d+)([MDN=X])", r[5]))
        return (*r[:4], r[3] + span, *r[4:9], r[9] or "*", r[10] or "*")

    return sorted(map(one, rs))


@pytest.mark.parametrize("split", [97, 1_000, 65_536, 1 << 25])
def test_round_trip(spark, tmp_path, split):
    rs = rows(700)
    bam.write_bam(spark.createDataFrame(rs, SCHEMA).repartition(3), f"{tmp_path}/b", LENGTHS, level=split % 5)
    got = bam.read_bam(spark, f"{tmp_path}/b", split_bytes=split * (20 if split < 1_000 else 1))
    assert sorted(map(tuple, got.collect())) == expected(rs)
    few = bam.read_bam(spark, f"{tmp_path}/b", "pos long, read_id string", split_bytes=1_000)
    assert few.columns == ["pos", "read_id"] and sorted(map(tuple, few.collect())) == sorted((r[3], r[0]) for r in rs)
    assert bam.read_header(next(p for p, *_ in bam.stores.files(f"{tmp_path}/b"))).names == [n for n, _ in LENGTHS]


def spanning(rs, size, cut=3_000):
    """A file whose blocks hold ``cut`` bytes each, wherever records begin, as some writers make them."""
    refs = {n: i for i, (n, _) in enumerate(LENGTHS)}
    names = SCHEMA.replace(" string", "").replace(" int", "").replace(" long", "").split(", ")
    data = bam.header_bytes(LENGTHS) + b"".join(bam.record_bytes(dict(zip(names, r, strict=True)), refs) for r in rs)
    return b"".join(bgzf.member(data[a : a + cut]) for a in range(0, len(data), cut)) + bgzf.END


@pytest.mark.parametrize("cut,longest", [(50, 60), (3_000, 120), (65_280, 120), (700, 20_000)])
def test_records_over_blocks(tmp_path, cut, longest):
    """Every record is read once, wherever stretches begin, also where a record is longer than several of them."""
    rs = rows(300 if longest < 1_000 else 60, 2, longest)
    path = tmp_path / "x.bam"
    path.write_bytes(spanning(rs, 0, cut))
    n = path.stat().st_size
    head = bam.read_header(str(path))
    for split in (211, 1_999, 8_192, n + 1):
        got = []
        for a in range(0, n, split):
            for batch in bam.records(bam.Stretch(str(path), a, min(a + split, n), head), list(bam._NAMES)):
                got += [tuple(r.values()) for r in batch.to_pylist()]
        assert sorted(got) == expected(rs), (cut, split)
        assert [r[0] for r in got] == [r[0] for r in rs]


def test_small_groups(tmp_path, monkeypatch):
    monkeypatch.setattr(bam, "_GROUP", 500)
    test_records_over_blocks(tmp_path, 200, 120)


def test_nothing_and_bad_files(spark, tmp_path):
    bam.write_bam(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none", LENGTHS)
    assert bam.read_bam(spark, f"{tmp_path}/none").count() == 0
    whole = spanning(rows(50, 3), 0)
    for name, raw in (("short", whole[: len(whole) // 2]), ("text", b"@HD\tVN:1.6\n" * 10_000), ("gone", None)):
        if raw is not None:
            (tmp_path / name).write_bytes(raw)
        with pytest.raises(Exception, match="BAM|block|cut off|FileNotFound|no such"):
            bam.read_bam(spark, f"{tmp_path}/{name}").count()
    with pytest.raises(Exception, match="no columns"):
        bam.read_bam(spark, f"{tmp_path}/none", "nothing string").count()
    long = [("n" * 255, 0, "chr1", 1, 0, "*", "*", -1, 0, None, None)]
    for bad in (long, [("a", 0, "chrX", 1, 0, "*", "*", -1, 0, None, None)], [("a", 0, "chr1", 1, 0, "*", "*", -1, 0, "ACG", "I")]):
        with pytest.raises(Exception, match="letters|chrX|qualities"):
            bam.write_bam(spark.createDataFrame(bad, SCHEMA), f"{tmp_path}/bad", LENGTHS)
    assert not [p for p in (tmp_path / "bad").iterdir() if not p.name.startswith((".", "_"))]


def test_overwritten(spark, tmp_path):
    for n in (20, 5):
        rs = rows(n, n)
        bam.write_bam(spark.createDataFrame(rs, SCHEMA).repartition(2), f"{tmp_path}/b", LENGTHS)
        assert sorted(map(tuple, bam.read_bam(spark, f"{tmp_path}/b").collect())) == expected(rs)


def test_blocks(tmp_path):
    rng = np.random.default_rng(1)
    parts = [b"", b"a" * 65_280, rng.integers(0, 256, 65_280, dtype=np.uint8).tobytes(), bgzf.MAGIC * 100]
    path = tmp_path / "z"
    path.write_bytes(b"".join(map(bgzf.member, parts)))
    with path.open("rb") as f:
        assert [d for _, d in bgzf.blocks(f, 0)] == parts
        where = [a for a, _ in bgzf.blocks(f, 0)]
        for start in range(0, path.stat().st_size, 37):
            assert bgzf.first_block(f, start, path.stat().st_size) == next((a for a in where if a >= start), None)
    import gzip

    assert b"".join(parts) == gzip.decompress(path.read_bytes()) and bgzf.is_blocked(path.read_bytes()) and not bgzf.is_blocked(gzip.compress(b"x"))
    assert [bam.bin_of(a, z) for a, z in ((0, 1), (0, 16_385), (1 << 28, (1 << 28) + 1), (0, 1 << 29))] == [4681, 585, 4681 + (1 << 14), 0]
    assert struct.calcsize("<iiBBHHHiiii") == 32
