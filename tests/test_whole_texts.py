"""Derived sequences hold every letter of every text, and the queries on them see all of it."""

import re

from pyspark.sql import functions as F
from smallest import DATA

from ligaspark.functions.sequences import all_starts
from ligaspark.plans import derive
from ligaspark.plans.registry import QUERIES

_TO = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


def letters(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: re.sub("[^a-z]", "", re.sub("[^A-Za-z]", "", r["text"] or "").lower()).translate(_TO) for r in rows}


def test_tiles_hold_every_letter(spark):
    want = letters(spark)
    got = {}
    for r in derive.tiles(spark, DATA).orderBy("rec_idx").collect():
        doc = int(r["seqid"][1:].split("_")[0])
        seq = r["seq"]
        if doc % 4:
            assert seq.endswith(derive.ADAPTER) and derive.LINKER in seq
            seq = seq.removesuffix(derive.ADAPTER).replace(derive.LINKER, "", 1)
        got[doc] = got.get(doc, "") + seq
    assert got == {k: v for k, v in want.items() if v}
    assert QUERIES["trim_reads_inexact"](spark, DATA).count() == derive.tiles(spark, DATA).count() > len(want)
    linked = derive.tiles(spark, DATA, linked=True)
    assert QUERIES["flag_counts"](spark, DATA).first()["total"] == linked.count() == linked.where(F.instr("seq", derive.LINKER) > 0).count()


def test_whole_sequences(spark):
    want = letters(spark)
    ends = QUERIES["restriction_scan"](spark, DATA).groupBy("chrom").agg(F.max("pos").alias("z")).collect()
    assert {r["chrom"]: r["z"] for r in ends} == {f"q{k}": len(v) for k, v in want.items()}
    assert QUERIES["base_frequency"](spark, DATA).agg(F.max("pos")).first()[0] == max(map(len, want.values())) - 1
    found = {(r["seqid"], r["start"]) for r in QUERIES["pattern_occurrences"](spark, DATA).collect()}
    assert found == {(f"q{k}", m.start()) for k, v in want.items() for m in re.finditer("(?=CGC)", v)}


def test_all_starts_of_awkward_sequences(spark):
    texts = ["CGCGCGC", "", "CG", "CGC", "ACGC", "CGCA", None, "ACGT" * 50_000 + "CGC"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(all_starts(F.col("s"), "CGC")).collect()]
    assert got == [[0, 2, 4], [], [], [0], [1], [0], None, [200_000]]
