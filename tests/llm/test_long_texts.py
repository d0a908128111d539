"""Texts longer than a pass of the byte operators, through every operator and every stage."""

import base64

import numpy as np
import pytest
from llm_data import frame, prose, words
from test_models import brute_statistics
from test_near_and_windows import brute_print

import corpus_pipeline
from ligaspark.llm import common, features, language, license_scan, packing, quality, simhash, toxicity

LONG = prose(__import__("random").Random(1), 240_000) + " mit license villain"  # 1.4 MB


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG.encode()) > common.PASS_BYTES
    return frame(spark, [(1, LONG, "en", "a", 1), (2, "short text of the ordinary kind villain", "en", "b", 1), (3, None, "en", "a", 1), (4, LONG + " tail", "de", "b", 1)])


def test_ids_of_a_long_text(spark, docs):
    got = {}
    for r in packing.pack(docs).collect():
        for (d, p), ids in packing.unpack(r).items():
            got.setdefault(d, {})[p] = ids
    with open(f"{common.tokenizer_dir()}/byte_bpe_50k.tiktoken", "rb") as f:
        encode = packing.encoder(f.read())
    want = np.append(encode(LONG, disallowed_special=()), packing.EOS)
    assert np.array_equal(np.concatenate([got[1][p] for p in sorted(got[1])]), want)


def test_licenses_of_a_long_text(docs):
    r = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}[1]
    n = len(words(LONG))
    assert (r["n_words"], r["n_base"], r["first_word"], r["labels"]) == (n, 1, n - 3, ["mit"])


def test_scores_of_a_long_text(spark, docs):
    import pyarrow as pa

    rows = [(100 + i, f"word{i} villain other", "en", "a", 1) for i in range(30)] + [(200 + i, f"word{i} plain other", "en", "a", 1) for i in range(60)]
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(30)] + [(200 + i, 0, 1) for i in range(60)], "doc_id long, toxic int, quality int")
    train = frame(spark, rows)
    toxic = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(train, labels, min_z=2.0)).collect()}
    assert toxic[1] == toxic[2] == toxic[4] >= 0.5 > toxic[3]
    assert {r["doc_id"] for r in quality.score(docs, quality.fit(train, labels)).collect()} == {1, 2, 3, 4}
    assert np.allclose(features.table(pa.array([LONG]))[0], brute_statistics(LONG), rtol=2e-5, atol=1e-6)


def test_language_of_a_long_text(spark, docs):
    models = [language.build({"en": [LONG[:20_000]], "zz": ["qzx wvk " * 200]})]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, models).collect()}
    assert got[1] == got[4] == "en" and got[3] == "und"


def test_fingerprint_of_a_long_text(docs):
    assert simhash.fingerprint(LONG.encode()) % 2**64 == brute_print(LONG)
    links = {r["doc_id"]: r["component"] for r in simhash.near_duplicates(docs).collect()}
    assert links[4] == links[1] == 1 and links[2] == 2


def test_a_hot_fingerprint_and_its_labels(spark, monkeypatch):
    rows = [(i, "the same text everywhere in here", "en", "a", 1) for i in range(300)] + [(1000 + i, prose(__import__("random").Random(i), 40), "en", "a", 1) for i in range(40)] + [(7, None, "en", "a", 1)]
    plain = sorted(map(tuple, simhash.near_duplicates(frame(spark, rows)).collect()), key=repr)
    monkeypatch.setattr(simhash, "_HOT", 3)
    assert sorted(map(tuple, simhash.near_duplicates(frame(spark, rows)).collect()), key=repr) == plain


def test_stages_on_a_long_text(spark, docs, tmp_path):
    spark.createDataFrame([(1, "no such passage in any of these texts at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = common.materialize(stage(spark, now, str(tmp_path)))
        if name != "packing":
            assert now.columns == docs.columns
    parts = sorted(p for r in now.collect() for d, p in zip(r["doc_ids"], r["parts"], strict=True) if d == 1)
    assert parts and parts[0] == 0 and set(range(max(parts) + 1)) == set(parts)


@pytest.mark.parametrize("unit", [" ", "\n", "a", "7", ".", " a", " \n", "\u3000"])
def test_five_megabytes_of_one_kind(spark, unit):
    """Packed and unpacked; the ids equal the plain encoding of the same kind of text below the length at which the plain encoder gives up."""
    import tiktoken

    with open(f"{common.tokenizer_dir()}/byte_bpe_50k.tiktoken", "rb") as f:
        raw = f.read()
    encode = packing.encoder(raw)
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines())}
    plain = tiktoken.Encoding("plain", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for tail in ("", "x", " x", "\nx", "7"):
        short = "head " + unit * 30_000 + tail
        assert np.array_equal(encode(short), plain.encode_to_numpy(short))
    text = unit * (5_000_000 // len(unit)) + "x"
    parts = {}
    for r in packing.pack(frame(spark, [(1, text, "en", "a", 1)])).collect():
        for (_, p), ids in packing.unpack(r).items():
            parts[p] = ids
    ids = np.concatenate([parts[p] for p in sorted(parts)])
    assert ids[-1] == packing.EOS and plain.decode(ids[:-1].tolist()) == text
