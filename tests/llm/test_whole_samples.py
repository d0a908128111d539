"""Samples come from the whole of a text."""

import pyarrow as pa
from llm_data import frame

from ligaspark.llm import language


def test_spread_covers_a_text():
    text = bytes(i % 251 for i in range(100_000))
    parts = language.spread(text, 1_000)
    assert sum(map(len, parts)) + len(parts) - 1 <= 1_000 and all(p in text for p in parts)
    assert language.spread(b"short", 5) == [b"short"] and language.spread(b"short", 0) == []


def test_language_is_learned_past_a_shared_opening(spark):
    head = "the common header of every page in this collection " * 8
    body = {"aa": "kato miru sopa lenu ", "bb": "zwrk drgn plst vchm "}
    rows = [(i, head + body[x] * 300, x, "s", 1) for i, x in enumerate(["aa", "bb"] * 40)]
    models = language.fit(frame(spark, rows), sample_bytes=4_096)
    assert language.predict(models, pa.array([body["aa"] * 5, body["bb"] * 5]))[0] == ["aa", "bb"]
