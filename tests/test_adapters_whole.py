"""Adapter inference, common substrings and the exact aligner where input is larger or other than usual."""

import random

from ligaspark.operators import adapters
from ligaspark.plans import derive, pipeline
from ligaspark.plans.registry import QUERIES


def test_more_than_2000_common_kmers(spark):
    rng = random.Random(5)
    tail = ""
    while len({tail[i : i + 11] for i in range(2_590)}) < 2_590:  # no way to go on but one
        tail = "".join(rng.choice("ACGT") for _ in range(2_600))
    reads = spark.createDataFrame([(i, "".join(rng.choice("ACGT") for _ in range(i)) + tail) for i in range(30)], "rec_idx long, seq string")
    assert tail in adapters.infer_adapter(reads, 30, 0, 0.75)


def test_linked_reads_by_what_they_hold(spark, monkeypatch):
    rows = [("a", 1, "G" * 9 + derive.LINKER + "CCCC" + derive.ADAPTER), ("b", 4, "T" * 7 + derive.LINKER + "GG" + derive.ADAPTER), ("c", 5, "A" * 50)]
    monkeypatch.setattr(derive, "tiles", lambda s, d: spark.createDataFrame(rows, "seqid string, rec_idx long, seq string"))
    got = {r["sub"] for r in QUERIES["common_substrings"](spark, "").collect()}
    assert {derive.LINKER[i : i + 6] for i in range(len(derive.LINKER) - 5)} <= got and "AAAAAA" not in got
    rows[:] = [(f"u{i}", 2 * i + 1, "ACGT"[i % 4] * 40) for i in range(8)] + [(f"l{i}", 4 * i, "TG" * i + derive.ADAPTER) for i in range(8)]
    assert QUERIES["adapter_inference"](spark, "").first()["adapter"] == derive.ADAPTER


def test_reads_of_more_than_200_bases(spark):
    rng = random.Random(7)
    seq = "".join(rng.choice("ACGT") for _ in range(1_000))
    genome = spark.createDataFrame([("chr1", seq)], "name string, seq string")
    reads = spark.createDataFrame([("long", seq[100:450], "I" * 350), ("off", seq[100:449] + ("A" if seq[449] != "A" else "C"), "I" * 350)], "seqid string, seq string, quality string")
    got = {r["read_id"]: (r["flag"], r["pos"], r["mapq"]) for r in pipeline.exact_aligner(genome, 20)(reads, 1).collect()}
    assert got["long"] == (0, 100, 60) and got["off"][0] == 4


def test_adapters_of_reads_with_gaps(spark):
    rng = random.Random(9)
    adapter = "AGATCGGAAGAGCACACGTCTGAACTCCAG"
    rows = []
    for i in range(60):
        at = rng.randrange(len(adapter))
        rows.append((i, adapter if i % 5 else adapter[:at] + adapter[at + 1 :]))  # every fifth read lacks a base
    reads = spark.createDataFrame(rows, "rec_idx long, seq string")
    assert adapters.infer_adapter(reads, 60, 0, 0.75, align=True) == adapter
    assert adapters.infer_adapter(reads.limit(0), 60, 0, 0.75, align=True) == ""


def test_frequencies_of_long_sequences(spark, monkeypatch):
    monkeypatch.setattr(adapters, "_TOGETHER", 7)
    seqs = ["ACGTNacgt-" * 3, "", None, "AC", "TTTTTTT", "éCGT"]
    df = spark.createDataFrame([(x,) for x in seqs], "seq string")
    want = {}
    for x in seqs:
        for i, c in enumerate((x or "").upper()):
            if c in "ATCG-":
                want.setdefault(i, {}).setdefault(c, 0)
                want[i][c] += 1
    got = {(r["pos"], r["base"]): r["p"] for r in adapters.base_frequency(df).collect()}
    assert got == {(i, c): n / sum(v.values()) for i, v in want.items() for c, n in v.items()}
