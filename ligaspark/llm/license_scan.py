"""License scan by ordered signature rules, all in Spark's own expressions.

A text becomes its words (ASCII letters lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``), each between two spaces of its own, so that a phrase is a plain
substring and two phrases never share a delimiter. A keyword prefilter on the raw text gates all rules: most texts are only counted. In the others, each rule's own keys
gate its regular expression, and matches become intervals of word numbers with the rule's label and rank. A detection is suppressed if its interval lies
within that of a detection of a better rank, or within a longer one (or the same one by an earlier rule) of its own rank.

Ranks: 1 exact identifiers and full legal names with a version, 2 sentences of license texts and notices, 3 general mentions. The rules are written by hand, in
``license_rules``; ties between rules of one rank and interval go to the one listed first.

Nothing is shuffled: a row's rules, suppression and labels are evaluated within the row. Null text: no words, no labels, score 0. Repeated rows each give
their row. A text of any length is one row; a gated one is held about three times over, as words, while it is scanned. Only id and text are read, so no other
column can clash. Empty tables give no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import compiled, listed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD_EITHER_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed phrases that always count, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
CONFIDENCE = {1: 1.0, 2: 0.9, 3: 0.6}


def as_pattern(words: str) -> str:
    """A phrase as a pattern over padded words."""
    return "".join(f" {w} " for w in words.split())


def rules() -> list[tuple[int, str, str, list[str], str]]:
    """(rank, label, gate, keys, pattern), in the order in which ties are decided.

    ``gate`` is one of a few strings that the prefilter looks for, ``keys`` are the rule's own; every match holds the gate and one of the keys. Patterns have no
    look-arounds.
    """
    out = [(rank, label, *compiled(signature)) for rank, label, signature in listed()]
    return out + [(3, label, *compiled(phrase)) for phrase, label in BASE.items()]


def gates(table: list[tuple[int, str, str, list[str], str]]) -> list[str]:
    """The strings of which every rule's match holds one, without those that contain another."""
    found = sorted({g for _, _, g, _, _ in table}, key=lambda g: (len(g), g))
    return [g for i, g in enumerate(found) if not any(x in g for x in found[:i])]


def may_match(text: Column, table: list[tuple[int, str, str, list[str], str]]) -> Column:
    """Whether the raw text holds all words of some gate; passes all texts that a rule can match, and few others. Searches are plain substrings."""
    low = F.lower(text)
    out = F.lit(False)
    for g in gates(table):
        all_words = F.lit(True)
        for w in g.split():
            all_words = all_words & F.contains(low, F.lit(w))
        out = out | all_words
    return out


def padded(text: Column) -> Column:
    """Every word between two spaces of its own: `` mit  license ``; an empty string if there are no words."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    words = F.trim(F.regexp_replace(low, NOT_WORD, "  "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def n_words(pad: Column) -> Column:
    """Words of a padded text, or of a part of one that ends between words: half of its spaces."""
    return F.floor((F.length(pad) - F.length(F.replace(pad, F.lit(" "), F.lit("")))) / 2).cast("long")


def count_words(text: Column) -> Column:
    """Words of a raw text: the pieces between other characters, less the empty ones at the ends."""
    t = F.coalesce(text, F.lit(""))
    ends = F.rlike(F.left(t, F.lit(1)), F.lit(NOT_WORD_EITHER_CASE)).cast("int") + F.rlike(F.right(t, F.lit(1)), F.lit(NOT_WORD_EITHER_CASE)).cast("int")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, NOT_WORD_EITHER_CASE)) - ends).cast("long")


def detections(pad: Column, table: list[tuple[int, str, str, list[str], str]]) -> Column:
    """array<struct<start, stop, rank, rule, label>>: intervals of word numbers, of all rules of which a key is there."""
    listed = [{"rank": rank, "rule": i, "label": label, "gate": gate, "keys": keys, "pattern": pattern} for i, (rank, label, gate, keys, pattern) in enumerate(table)]
    packed = F.from_json(F.lit(json.dumps(listed)), "array<struct<rank:int,rule:int,label:string,gate:string,keys:array<string>,pattern:string>>")  # folded to a literal

    def of_rule(r):
        gaps, hits = F.split(pad, r["pattern"], -1), F.regexp_extract_all(pad, r["pattern"], F.lit(0))
        gap_words, hit_words = F.transform(gaps, n_words), F.transform(hits, n_words)
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("out"))

        def step(acc, both):
            a = acc["at"] + both["gap"]
            z = a + both["hit"]
            return F.struct(z.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("start"), z.alias("stop")))).alias("out"))

        pairs = F.zip_with(F.slice(gap_words, F.lit(1), F.size(hit_words)), hit_words, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        spans = F.aggregate(pairs, empty, step, lambda acc: acc["out"])
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), r["rank"].alias("rank"), r["rule"].alias("rule"), r["label"].alias("label")))

    # the gates that are there, as the variable of a lambda, so that they are found once and not for every rule
    there = F.filter(F.array(*[F.lit(g) for g in sorted({r["gate"] for r in listed})]), lambda g: F.contains(pad, g))
    some = F.transform(F.array(there), lambda found: F.filter(packed, lambda r: F.array_contains(found, r["gate"]) & F.exists(r["keys"], lambda k: F.contains(pad, k))))
    return F.flatten(F.transform(F.flatten(some), of_rule))


def suppressed(found: Column) -> Column:
    """What is left of ``found`` when contained detections are gone: one fold over the intervals by start, longest first, with the furthest end per rank."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("back"), d["rank"].alias("rank"), d["rule"].alias("rule"), d["label"].alias("label"))))
    kind = "array<struct<start:bigint,stop:bigint,rank:int,rule:int,label:string>>"
    empty = F.struct(*[F.lit(-1).cast("long").alias(f"e{k}") for k in (1, 2, 3)], F.array().cast(kind).alias("out"))

    def step(acc, d):
        stop = -d["back"]
        inside = ((d["rank"] >= 1) & (acc["e1"] >= stop)) | ((d["rank"] >= 2) & (acc["e2"] >= stop)) | ((d["rank"] >= 3) & (acc["e3"] >= stop))
        one = F.array(F.struct(d["start"].alias("start"), stop.alias("stop"), d["rank"].alias("rank"), d["rule"].alias("rule"), d["label"].alias("label")))
        ends = [F.when((d["rank"] == k) & (stop > acc[f"e{k}"]), stop).otherwise(acc[f"e{k}"]).alias(f"e{k}") for k in (1, 2, 3)]
        return F.struct(*ends, F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

    return F.aggregate(order, empty, step, lambda acc: acc["out"])


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels array, labels array, score, spans array of kept detections)."""
    table = rules()
    base = "(?:" + "|".join(as_pattern(p) for p in BASE) + ")"
    any_base, last_base = "(?s)^(.*?)" + base, "(?s)^(.*)" + base
    nothing = F.array().cast("array<struct<start:bigint,stop:bigint,rank:int,rule:int,label:string>>")
    text_col = F.col(f"`{text}`").cast("string")
    counted = docs.select(F.col(f"`{id_col}`").alias("id"), count_words(text_col).alias("n_words"), F.when(may_match(text_col, table), text_col).alias("text"))
    pads = counted.select("id", "n_words", F.when(F.col("text").isNotNull(), padded(F.col("text"))).otherwise(F.lit("")).alias("pad"))
    gated = F.rlike("pad", F.lit("|".join(gates(table))))
    rows = pads.select("*", F.when(F.contains("pad", F.lit(" license ")), F.regexp_count("pad", F.lit(base))).otherwise(0).cast("long").alias("n_base"), F.when(gated, suppressed(detections(F.col("pad"), table))).otherwise(nothing).alias("spans"))
    some = F.col("n_base") > 0
    first = F.when(some, n_words(F.regexp_extract("pad", any_base, 1)))
    last = F.when(some, n_words(F.regexp_extract("pad", last_base, 1)))
    own = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(some & F.contains("pad", F.lit(as_pattern(p))), F.lit(v)) for p, v in BASE.items()]), lambda x: x.isNotNull())))
    score = F.aggregate(F.transform("spans", lambda d: F.when(d["rank"] == 1, CONFIDENCE[1]).when(d["rank"] == 2, CONFIDENCE[2]).otherwise(CONFIDENCE[3])), F.lit(0.0), lambda a, x: F.greatest(a, x))
    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_base", first.alias("first_word"), last.alias("last_word"), own.alias("base_labels"),
        F.array_sort(F.array_union(own, F.transform("spans", lambda d: d["label"]))).alias("labels"), F.greatest(score, F.when(some, CONFIDENCE[3]).otherwise(0.0)).alias("score"), "spans",
    )

