"""Queries against their SQL on tables with what only larger ones hold."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from smallest import DATA, TABLES

from __spark_entry__ import oracle_sql, queries
from ligaspark.functions import alignment
from ligaspark.operators import adapters, contacts, fragments
from ligaspark.plans import derive, file_queries
from ligaspark.sources import fastx, fastx_source, text


@pytest.fixture
def larger(spark, tmp_path):
    """Asserts that a query gives its SQL's rows on the smallest tables, some of which are made anew by SQL over the old."""

    def check(name, tables):
        c = duckdb.connect()
        for t in TABLES:
            path = f"{tmp_path}/{t}.parquet"
            if t in tables:
                c.execute(f"COPY ({tables[t].format(f"'{DATA}/{t}.parquet'")}) TO '{path}'")
            elif not os.path.exists(path):
                os.symlink(f"{DATA}/{t}.parquet", path)
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
        df = queries()[name](spark, str(tmp_path))
        rows = c.execute(oracle_sql()[name])
        at = [d[0] for d in rows.description]
        want = sorted((tuple(r) for r in rows.fetchall()), key=repr)
        assert sorted(map(tuple, df.select(*at).collect()), key=repr) == want and want

    return check


def test_sequences_without_a_letter(larger):
    larger("base_frequency", {"documents": "SELECT * REPLACE (CASE WHEN doc_id % 9 = 1 THEN '12 !' WHEN doc_id % 9 = 2 THEN NULL ELSE text END AS text) FROM {}"})


def test_pieces_across_stretches(larger, monkeypatch):
    monkeypatch.setattr(fastx_source.read_pieces, "__defaults__", (fastx_source.PIECE, 1_111))
    larger("fasta_pieces", {"documents": "SELECT * REPLACE (CASE WHEN doc_id % 9 = 1 THEN '12 !' ELSE text END AS text) FROM {}"})


@pytest.mark.parametrize("split", [40, 97, 411])
def test_pieces_are_whole(spark, tmp_path, split):
    sizes = [0, 1, 99, 100, 101, 700, 0, 1_234]
    seqs = [("ACGTTGCAAC" * 200)[k : k + n] for k, n in enumerate(sizes)]
    (tmp_path / "a.fa").write_text("".join(f">s{k}\n" + "".join(q[a : a + 37] + "\n\n" for a in range(0, len(q), 37)) for k, q in enumerate(seqs)))
    got = sorted(tuple(r) for r in fastx_source.read_pieces(spark, str(tmp_path), 100, split).select("name", "start", "seq").collect())
    assert got == sorted((f"s{k}", a, q[a : a + 100]) for k, q in enumerate(seqs) for a in range(0, max(1, len(q)), 100))


def test_contacts_beyond_the_chromosomes(larger):
    larger("hic_round_trip", {"lineitem": "SELECT * REPLACE (l_partkey + 205900 AS l_partkey) FROM {}"})


def test_lines_of_lengths_are_split_once(spark, tmp_path):
    rows = spark.range(300_000, numPartitions=1).select(F.lit("c").alias("chrom"), (F.col("id") % 97).alias("length"))
    text.write_lengths(rows, f"{tmp_path}/n")
    assert spark.read.text(f"{tmp_path}/n").select(F.max(F.size(F.split("value", "\t")))).first()[0] <= 4_097
    back = text.read_lengths(spark, f"{tmp_path}/n")
    assert back._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert back.groupBy("length").count().exceptAll(rows.groupBy("length").count()).count() == 0 and back.count() == 300_000


def test_statistics_are_not_made_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "coalesce", None)
    assert queries()["statistics_round_trip"](spark, DATA).count() == 5


def test_chromosomes_listed_move_no_contacts(spark):
    plan = queries()["chrom_whitelist_semi"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_sort_by_first_end_has_no_open_ties(spark):
    rows = [("chr10", 5, 9, "b"), ("chr2", 7, 9, "a"), ("chr10", 5, 9, "a"), ("chr10", None, 9, "c"), ("chr10", 5, 8, "d"), (None, 1, 2, "e"), ("chrX", 1, 2, "f"), ("chr2", 6, 9, "g")]
    df = spark.createDataFrame(rows, "chr1 string, start1 long, end1 long, name string")
    assert [r["name"] for r in contacts.sort_by_first(df, "name").collect()] == ["e", "g", "a", "c", "d", "a", "b", "f"]


def test_common_substrings_leave_tasks_as_candidates(spark):
    frame = lambda *t: spark.createDataFrame([(x,) for x in t], "seq string").repartition(3)
    found = lambda *t: sorted(r[0] for r in adapters.common_substrings(frame(*t), 3).collect())
    assert found("ACGTA", "TTACGTA", "ACGTACGT") == ["ACG", "CGT", "GTA"] and found("ACGT", None) == found("ACGT", "AC") == found() == []
    assert "Generate explode" not in adapters.common_substrings(frame("ACGT"), 3)._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[-1]


def test_numbering_moves_no_lines(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@a\nAC\n+\nII\n@b\nA\n+\n@\n")
    df = fastx.read_fastq(spark, str(tmp_path), str(tmp_path / "a.fastq"))
    assert sorted(map(tuple, df.collect())) == [(0, "a", "AC", "II"), (1, "b", "A", "@"), (2, "a", "AC", "II"), (3, "b", "A", "@")]
    assert "SortMergeJoin" not in df._jdf.queryExecution().optimizedPlan().toString() and df._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == 2


def test_many_reads_are_aligned_some_at_a_time(monkeypatch):
    rng = random.Random(5)
    reads = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    whole = alignment.locate_many(reads, "GACCTGAATTC").tolist()
    monkeypatch.setattr(alignment, "_TOGETHER", 7)
    assert alignment.locate_many(reads, "GACCTGAATTC").tolist() == whole


def test_files_of_pairs_grow_in_number(spark, monkeypatch):
    made = []
    monkeypatch.setattr(file_queries, "_PAIRS_A_FILE", 100, raising=False)
    monkeypatch.setattr(file_queries.counters, "stream_pairs", lambda s, path, files_per_trigger: made.append((s.read.text(path).inputFiles(), files_per_trigger)))
    file_queries._pair_files(spark, DATA)
    (files, n), want = made[0], -(-derive.contacts(spark, DATA).count() // 100)
    assert len(files) == want > 6 and n == want // 3


def test_chromosomes_with_sites_move_no_contacts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fragments.classify(derive.contacts(spark, DATA), derive.sites(spark, DATA), 4, method="arrays")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
