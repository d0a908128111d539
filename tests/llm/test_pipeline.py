import random

import numpy as np
import pytest
from llm_data import awkward, frame, prose, tokens
from test_near_and_windows import brute_components, brute_hits, brute_print

import corpus_pipeline
from ligaspark.llm import packing
from ligaspark.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, same_rows):
    same_rows(QUERIES[name], ORACLES[name])


def test_names():
    import __spark_entry__ as e

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "near-duplicates", "decontamination", "mixing", "packing"]
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES} and set(QUERIES) | {"pipeline"} <= set(e.queries())


def test_stages(spark, tmp_path):
    rng = random.Random(20)
    items = [(1, prose(rng, 30)), (2, prose(rng, 12))]
    rows = awkward(21, 40) + [(6000 + i, prose(rng, 50), "en", "s1", 1) for i in range(20)] + [(7000 + i, prose(rng, 20) + " " + items[i % 2][1], "de", "s2", 1) for i in range(6)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language ID"](spark, docs, str(tmp_path))
    assert one.columns == docs.columns
    kept = [tuple(r) for r in one.collect()]
    assert sorted(kept, key=repr) == sorted((tuple(r) for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")), key=repr)
    two = stages["near-duplicates"](spark, one, str(tmp_path))
    have = sorted(((r["doc_id"], brute_print(r["text"])) for r in two.collect()), key=repr)
    groups = brute_components([(r[0], r[1]) for r in kept])
    assert have == sorted({(i, f) for i, f, c in groups if i == c}, key=repr)
    three = stages["decontamination"](spark, two, str(tmp_path))
    left = [r for r in two.collect() if not brute_hits(r["text"], items)[-1]]
    assert sorted(map(tuple, three.collect()), key=repr) == sorted(map(tuple, left), key=repr) and len(left) < two.count()
    four = stages["mixing"](spark, three, str(tmp_path))
    assert four.columns == docs.columns and four.count() > 0 and {r["text"] for r in four.collect()} <= {r["text"] for r in left}
    five = stages["packing"](spark, four, str(tmp_path)).collect()
    segments = [d for r in five for d, p in zip(r["doc_ids"], r["parts"], strict=True) if p == 0]
    assert sorted(segments, key=repr) == sorted((r["doc_id"] for r in four.collect()), key=repr)
    assert all(len(r["ids"]) == 2 * r["n_rows"] * packing.SEQ_LEN for r in five)
    assert sum(np.count_nonzero(np.frombuffer(r["ids"], np.uint16) != packing.EOS) for r in five) > sum(len(tokens(r["text"])) for r in four.collect()) * 0.9


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "doc_ids" in out.columns


def test_run_of_nothing(spark, tmp_path):
    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
