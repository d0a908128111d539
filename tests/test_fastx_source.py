"""FASTQ and FASTA as data sources: every record once, wherever stretches begin."""

import gzip
import random

import pytest

from ligaspark.sources import bgzf
from ligaspark.sources import fastx_source as fx


def fastq(n, seed=1, longest=60, crlf=False):
    """Text and records; qualities begin with marks of headers and of third lines."""
    rng, out, text = random.Random(seed), [], []
    for i in range(n):
        k = rng.choice([0, 1, 2, rng.randint(3, longest)])
        seq = "".join(rng.choice("ACGTN") for _ in range(k))
        qual = "".join(rng.choice("@+@+!IJ~") for _ in range(k))
        out.append((f"r{i}", seq, qual))
        text.append("\r\n".join([f"@r{i} more words {i}", seq, "+", qual, ""]) if crlf else f"@r{i}\tx\n{seq}\n+{'r' * (i % 3)}\n{qual}\n")
    return "".join(text), out


def blocked(data, cut):
    return b"".join(bgzf.member(data[a : a + cut]) for a in range(0, len(data), cut)) + bgzf.END


def scan(path, split, rows=fx.fastq_records, wanted=("seqid", "seq", "quality")):
    return [tuple(r.values()) for p in fx.plan(fx.stores.files(str(path)), split) for b in rows(p, list(wanted)) for r in b.to_pylist()]


@pytest.mark.parametrize("chunk", [4 << 20, 64])
def test_every_record_once(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(fx, "_CHUNK", chunk)
    for seed, longest, crlf in ((1, 60, False), (2, 5, True), (3, 900, False)):
        text, want = fastq(150, seed, longest, crlf)
        data = text.encode()
        for name, raw in (("plain", data), ("blocked", blocked(data, 333)), ("gzip", gzip.compress(data[:999]) + gzip.compress(data[999:])), ("tail", data.rstrip(b"\r\n") if data.rstrip(b"\r\n").endswith(want[-1][2].encode()) and want[-1][2] else data)):
            path = tmp_path / f"{seed}{name}"
            path.write_bytes(raw)
            for split in (1, 7, 64, 401, 5_000, 1 << 20) if chunk > 64 else (7, 401):
                if split == 1 and (longest > 60 or name == "blocked"):
                    continue
                assert scan(path, split) == want, (name, split, seed)


def test_partial_and_empty(tmp_path):
    (tmp_path / "a").write_text("@a\nAC\n+\nII\n@b\nACG\n+\n")
    (tmp_path / "b").write_text("")
    (tmp_path / "c").write_text("@c\nA\n+\n@")
    for split in (1, 3, 100):
        assert scan(tmp_path / "a", split) == [("a", "AC", "II")] and scan(tmp_path / "b", split) == [] and scan(tmp_path / "c", split) == [("c", "A", "@")]


def test_plan_of_a_scan(spark, tmp_path):
    """One scan, no join and no shuffle; fewer columns if asked for."""
    text, want = fastq(500)
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "_hidden").write_text("@no\n\n+\n\n")
    df = fx.read_fastq(spark, str(tmp_path), split_bytes=1_000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    got = df.orderBy("file", "part", "nth").select("seqid", "seq", "quality").collect()
    assert list(map(tuple, got)) == want * 2 and df.rdd.getNumPartitions() > 10
    few = fx.read_fastq(spark, str(tmp_path), "seq string", split_bytes=1_000)
    assert few.columns == ["seq"] and few.count() == 1_000


def test_stream(spark, tmp_path):
    """Files that arrive between runs of one query are read once each."""
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    want = []
    for k in range(3):
        text, rows = fastq(40, k)
        (source / f"{k}.fastq").write_text(text)
        want += rows
        q = fx.stream_fastq(spark, str(source), split_bytes=300).writeStream.format("parquet").option("checkpointLocation", str(state)).trigger(availableNow=True).start(str(out))
        q.awaitTermination(60)
        q.stop()
        assert sorted(tuple(r) for r in spark.read.parquet(str(out)).select("seqid", "seq", "quality").collect()) == sorted(want)


def fasta(n, seed, longest, width):
    rng, text, want = random.Random(seed), "; a comment line\n", []
    for i in range(n):
        seq = "".join(rng.choice("ACGTacgtN") for _ in range(rng.choice([0, 1, rng.randint(2, longest)])))
        want.append((f"c{i} of {n}", seq))
        text += f">c{i} of {n}\n" + "".join(seq[a : a + width] + "\n" for a in range(0, len(seq), width)) + "\n" * (i % 2)
    return text, want


def test_pieces_in_their_places(spark, tmp_path):
    for seed, longest, width, split, piece in ((1, 300, 60, 97, 50), (2, 5_000, 70, 411, 1_000), (3, 20, 7, 13, 1 << 20), (4, 4_000, 10_000, 500, 64)):
        text, want = fasta(25, seed, longest, width)
        folder = tmp_path / str(seed)
        folder.mkdir()
        (folder / "g.fa").write_text(text)
        (folder / "h.fa.gz").write_bytes(blocked(text.encode(), 500))
        got = {}
        for r in fx.read_pieces(spark, str(folder), piece, split).collect():
            assert len(r["seq"]) <= piece
            got.setdefault((r["file"][-4:], r["record"], r["name"]), []).append((r["start"], r["seq"]))
        for end in ("g.fa", "a.gz"):
            joined = []
            for key in sorted(k for k in got if k[0] == end):
                parts, at = sorted(got[key]), 0
                for start, seq in parts:
                    assert start == at or not seq
                    at += len(seq)
                joined.append((key[2], "".join(s for _, s in parts)))
            assert joined == want, (seed, end)
