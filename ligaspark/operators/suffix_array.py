"""Suffix arrays of tables of sequences, with the values of longest common prefixes, searches for many patterns, and the longest substring that sequences share.

The order comes from prefix doubling (Manber and Myers 1993) as joins and sums. A suffix is first ranked by its ``FIRST`` letters; a round that knows ranks by k
letters ranks by 2k, as the second half of a suffix's 2k letters is the first half of the suffix k places on. A rank is the number of suffixes that sort before
all of its group, so groups split in place, and a round moves only suffixes whose rank is still shared. Ranks that are shared at k letters name substrings of that
length (Karp, Miller and Rosenberg 1972): two substrings of any length L from k to 2k are the same where their first and their last k letters have the same names.

Each step is a join by place, which no key can crowd, or a sum over distinct keys laid out by range; a key that very many suffixes have is counted before it is
ranked, and meets its rows in a join that adaptive execution splits. Tables of a round are written to the shared folder, so plans stay short.

A name stands for one row. Null and empty sequences have no suffixes. A shorter suffix sorts before those that begin with it; equal ones sort by name and place.
Letters compare by their UTF-8 bytes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, written

FIRST = 16  # letters by which suffixes are ranked at first
PIECE = 512  # letters of the pieces in which windows are cut, as a substring by place walks a text from its beginning


class Ranks(NamedTuple):
    """``suffixes``: (name, pos, left, word, rank), the letters to the end and the first ones; ``shared``: by length k, (name, pos, left, rank) of ranks that several have."""

    suffixes: DataFrame
    shared: dict[int, DataFrame]

    def discard(self) -> None:
        discard(self.suffixes, *self.shared.values())


def windows(seqs: DataFrame, name: str = "name", seq: str = "seq", k: int = FIRST) -> DataFrame:
    """(name, pos, left, word): up to k letters from each place of each sequence, places from 0."""
    cut = seqs.select(F.col(name).cast("string").alias("name"), F.length(seq).cast("long").alias("_n"), F.regexp_extract_all(F.col(seq), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("_c"))
    own = F.transform("_c", lambda c, i: F.struct(F.length(c).alias("n"), F.concat(c, F.left(F.coalesce(F.get("_c", i + 1), F.lit("")), F.lit(k - 1))).alias("t")))
    pieces = cut.select("name", "_n", F.posexplode(own).alias("_p", "_s"))
    words = F.transform(F.sequence(F.lit(0), F.col("_s.n") - 1), lambda i: F.substr(F.col("_s.t"), i + 1, F.lit(k)))
    rows = pieces.select("name", "_n", "_p", F.posexplode(words).alias("_i", "word"))
    pos = F.col("_p").cast("long") * PIECE + F.col("_i")
    return rows.select("name", pos.alias("pos"), (F.col("_n") - pos).alias("left"), "word")


def running(df: DataFrame, order: list[str], n: str | None = None) -> DataFrame:
    """``df`` with ``before``: the sum of ``n`` (without it, the number) of the rows that sort before; the order has to tell all rows apart. A written table.

    Rows are laid out by range; sums run within a range, and over one total for each range.
    """
    one = F.col(n) if n else F.lit(1).cast("long")
    dealt = written(df.repartitionByRange(*order).withColumn("_n", one).withColumn("_p", F.spark_partition_id()))
    sofar = F.coalesce(F.sum("_n").over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = dealt.groupBy("_p").agg(F.sum("_n").alias("_t"))  # a row for each partition
    base = totals.select("_p", F.coalesce(F.sum("_t").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    out = written(dealt.withColumn("_w", sofar).join(F.broadcast(base), "_p").withColumn("before", F.col("_b") + F.col("_w")).drop("_p", "_n", "_w", "_b"))
    discard(dealt)
    return out


def ranks(seqs: DataFrame, name: str = "name", seq: str = "seq") -> Ranks:
    first = written(windows(seqs, name, seq))
    keys = running(first.groupBy("word").agg(F.count(F.lit(1)).alias("n")), ["word"], "n")
    now = written(first.join(keys.select("word", F.col("before").alias("rank"), "n"), "word").select("name", "pos", "left", "word", "rank", "n", (F.col("n") > 1).alias("open")))
    discard(first, keys)
    shared, k = {}, FIRST
    while True:
        several = now.where("n > 1").select("name", "pos", "left", "rank")
        shared[k] = written(several)
        if now.where("open").isEmpty():
            return Ranks(now.select("name", "pos", "left", "word", "rank"), shared)
        after = now.select("name", (F.col("pos") - k).alias("pos"), F.col("rank").alias("second"))
        halves = written(now.where("open").drop("n", "open").join(after, ["name", "pos"], "left").withColumn("second", F.coalesce("second", F.lit(-1))))
        pairs = running(halves.groupBy("rank", "second").agg(F.count(F.lit(1)).alias("n")), ["rank", "second"], "n")
        base = pairs.groupBy("rank").agg(F.min("before").alias("_first"))
        to = pairs.join(base, "rank").select("rank", "second", "n", (F.col("rank") + F.col("before") - F.col("_first")).alias("to"))
        # where nothing follows, those of one rank are equal to their ends
        split = halves.join(to, ["rank", "second"]).select("name", "pos", "left", "word", F.col("to").alias("rank"), "n", ((F.col("n") > 1) & (F.col("second") >= 0)).alias("open"))
        made = written(now.where("NOT open").unionByName(split))
        discard(now, halves, pairs)
        now, k = made, 2 * k


def suffix_array(found: Ranks) -> DataFrame:
    """(ord, name, pos, lcp): all suffixes in order from 0, and how many letters each has in common with the one before (0 for the first)."""
    rows = running(found.suffixes.select("rank", "name", "pos", "left", "word"), ["rank", "name", "pos"]).withColumnRenamed("before", "ord")
    prev = rows.select((F.col("ord") + 1).alias("ord"), F.col("name").alias("name2"), F.col("pos").alias("pos2"), F.col("left").alias("left2"))
    pairs = rows.select("ord", "name", "pos", "left").join(prev, "ord", "left").withColumn("lcp", F.lit(0).cast("long"))
    step = None
    for k in sorted(found.shared, reverse=True):
        for side in ("", "2"):
            here = found.shared[k].select(F.col("name").alias(f"name{side}"), F.col("pos").alias(f"_at{side}"), F.col("rank").alias(f"_r{side}"))
            pairs = pairs.withColumn(f"_at{side}", F.col(f"pos{side}") + F.col("lcp")).join(here, [f"name{side}", f"_at{side}"], "left")
        same = F.when(F.col("_r") == F.col("_r2"), F.least(F.col("lcp") + k, "left", "left2")).otherwise(F.col("lcp"))
        last, step = step, written(pairs.select("ord", "name", "pos", "left", "name2", "pos2", "left2", same.alias("lcp")))
        discard(*([rows] if last is None else [last]))
        pairs = step
    ends = pairs
    for side in ("", "2"):
        here = found.suffixes.select(F.col("name").alias(f"name{side}"), F.col("pos").alias(f"_at{side}"), F.col("word").alias(f"_w{side}"))
        ends = ends.withColumn(f"_at{side}", F.col(f"pos{side}") + F.col("lcp")).join(here, [f"name{side}", f"_at{side}"], "left")
    most = F.least(F.length("_w"), F.length("_w2"))  # null where either is at its end
    more = F.aggregate(F.sequence(F.lit(1), F.lit(FIRST)), F.lit(0), lambda n, i: F.when((i <= most) & (F.left("_w", i) == F.left("_w2", i)), i).otherwise(n))
    return ends.select("ord", "name", "pos", (F.col("lcp") + F.coalesce(more, F.lit(0))).alias("lcp"))


def _within(found: Ranks, length: int) -> DataFrame:
    """(name, pos, *key): the places with that many letters left and names of their first so many letters; only places whose letters several have, if there are many."""
    if length <= FIRST:
        return found.suffixes.where(F.col("left") >= length).select("name", "pos", F.left("word", F.lit(length)).alias("_a"), F.lit(0).alias("_z"))
    k = FIRST
    while 2 * k <= length:
        k *= 2
    if k not in found.shared:
        return found.suffixes.select("name", "pos", F.col("word").alias("_a"), F.lit(0).alias("_z")).limit(0)
    rows = found.shared[k]
    last = rows.select("name", (F.col("pos") - (length - k)).alias("pos"), F.col("rank").alias("_z"))
    return rows.where(F.col("left") >= length).select("name", "pos", F.col("rank").alias("_a")).join(last, ["name", "pos"])


def longest_shared(found: Ranks, least: int = 2) -> tuple[int, DataFrame]:
    """The length of the longest substring that at least so many sequences have (0: none), and its places (name, pos, item), ``item`` telling substrings of that length apart.

    Part of a shared substring is shared, so lengths are searched by doubling and then by halves; each is one count over names of substrings.
    """
    if least < 1:
        raise ValueError("at least one sequence has to hold it")

    def groups(length):
        return _within(found, length).select("_a", "_z", "name").distinct().groupBy("_a", "_z").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= least).select("_a", "_z")

    low, high = 0, 1
    while not groups(high).isEmpty():
        low, high = high, 2 * high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if groups(mid).isEmpty() else (mid, high)
    places = _within(found, max(low, 1)).join(groups(max(low, 1)), ["_a", "_z"])
    return low, (places if low else places.limit(0)).select("name", "pos", F.struct("_a", "_z").alias("item"))


def longest_common(found: Ranks, least: int) -> str:
    """That substring itself, the first in order if there are several."""
    length, places = longest_shared(found, least)
    if not length:
        return ""
    row = places.join(found.suffixes.select("name", "pos", "rank"), ["name", "pos"]).orderBy("rank", "name", "pos").first()
    words = found.suffixes.where((F.col("name") == row["name"]) & F.col("pos").between(row["pos"], row["pos"] + length - 1) & ((F.col("pos") - row["pos"]) % FIRST == 0))
    return "".join(r["word"] for r in words.orderBy("pos").collect())[:length]  # one substring


def occurrences(seqs: DataFrame, patterns: DataFrame, name: str = "name", seq: str = "seq", pattern_id: str = "pattern_id", pattern: str = "pattern") -> DataFrame:
    """(pattern_id, name, pos): every place of every pattern, of any lengths, overlapping ones too; ids as strings. Null and empty patterns are nowhere.

    Patterns are ranked with the sequences. One of ``FIRST`` letters or fewer is joined with first letters; a longer one of L letters with the places that have the name of
    its first k letters, k at least half of L, and those are held against the name of its last k. So what is looked at is as much as its first half occurs.
    """
    texts = seqs.select(F.concat(F.lit("t"), F.col(name).cast("string")).alias("name"), F.col(seq).alias("seq"))
    wanted = patterns.where(F.length(pattern) > 0).select(F.concat(F.lit("p"), F.col(pattern_id).cast("string")).alias("name"), F.col(pattern).alias("seq"))
    found = ranks(texts.unionByName(wanted))
    heads = found.suffixes.where(F.col("name").startswith("p") & (F.col("pos") == 0)).select(F.col("name").alias("pattern_id"), F.col("left").alias("len"), "word", "rank")
    places = found.suffixes.where(F.col("name").startswith("t"))
    short = heads.where(F.col("len") <= FIRST)
    lengths = sorted(r["len"] for r in short.select("len").distinct().collect())  # FIRST numbers at most
    parts = []
    if lengths:
        cut = places.select("name", "pos", "left", "word", F.explode(F.array(*[F.lit(n).cast("long") for n in lengths])).alias("len")).where(F.col("left") >= F.col("len"))
        cut = cut.select("name", "pos", "len", F.left("word", F.col("len").cast("int")).alias("word"))
        parts.append(short.select("pattern_id", "len", "word").join(cut, ["len", "word"]).select("pattern_id", "name", "pos"))
    for k, rows in sorted(found.shared.items()):
        here = heads.where((F.col("len") >= max(k, FIRST + 1)) & (F.col("len") < 2 * k)).select(F.col("pattern_id").alias("name"), "len")
        of = here.join(rows.where("pos = 0").select("name", F.col("rank").alias("a")), "name")
        of = of.withColumn("pos", F.col("len") - k).join(rows.select("name", "pos", F.col("rank").alias("z")), ["name", "pos"]).select(F.col("name").alias("pattern_id"), "len", "a", "z")
        own = rows.where(F.col("name").startswith("t"))
        near = of.join(own.select("name", F.col("pos").alias("at"), F.col("rank").alias("a"), "left"), "a").where(F.col("left") >= F.col("len"))
        near = near.withColumn("pos", F.col("at") + F.col("len") - k).join(own.select("name", "pos", F.col("rank").alias("z")), ["name", "pos", "z"])
        parts.append(near.select("pattern_id", "name", F.col("at").alias("pos")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.expr("substr(pattern_id, 2)").alias("pattern_id"), F.expr("substr(name, 2)").alias("name"), "pos")
