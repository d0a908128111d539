"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's words (ASCII letters lower-cased, split at ASCII white space) give ``width``-word shingles, repeats included; a bit of the 64-bit fingerprint is 1 if
it is set in over half of the shingles' XXH64 values (UTF-8, seed 42). A text of fewer words is one shingle; one without words has fingerprint 0 and is
linked like any other.

Linking at a distance of at most 2: every distinct fingerprint emits the 65 values within 1 bit of itself. Two fingerprints at distance 2 or less share such
a value, and all that share one are within 2 of each other, so linking each to the smallest of its value is complete and exact, and no pairs of a group are
emitted. A value has at most 65 fingerprints within 1 bit: no group grows with the data. Copies collapse to one fingerprint before anything is emitted, by
an aggregate that is combined before the shuffle. Components come from alternating large-star and small-star steps over written tables.

Null text counts as empty; a null id takes part but is never a component's id unless nothing else is there. Repeated rows each give their row. Ties (bits set in
exactly half of the shingles) are 0. A very long text is taken in stretches. Only id and text are read for the links, and ``keep_first`` joins under names of its
own, so no column can clash. Empty tables give no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_text, materialize

WIDTH = 3
_HASHES = 65_536  # bit counts are summed over so many shingles at a time
_HOT = 10_000
_STRETCH = 262_144  # bytes of a text that are split into words together, and on to the next white space
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """As a signed 64-bit integer. A long text is taken in stretches that end at white space, with the last words of one before the next, so what is held besides
    the text is that of one stretch."""
    counts, n, carry, at = np.zeros(64, dtype=np.int64), 0, [], 0
    h = xxhash.xxh64_intdigest
    while at < len(text):
        gap = _SPACE.search(text, at + _STRETCH)
        stop = gap.start() if gap else len(text)
        words = carry + text[at:stop].lower().split()
        at = stop
        if len(words) < width and at < len(text):
            carry = words
            continue
        if len(words) < width:
            if n or not words:
                break
            return _signed(np.unpackbits(np.array([h(b" ".join(words), 42)], dtype=np.uint64).view(np.uint8), bitorder="little"))
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: len(words) - width].tolist()]
        hashes = np.array([h(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)], dtype=np.uint64)
        for a in range(0, len(hashes), _HASHES):
            counts += np.unpackbits(hashes[a : a + _HASHES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        carry = words[len(words) - width + 1 :]
    if not n and carry:
        return _signed(np.unpackbits(np.array([h(b" ".join(carry), 42)], dtype=np.uint64).view(np.uint8), bitorder="little"))
    return _signed(counts * 2 > n) if n else 0


def _signed(bits: np.ndarray) -> int:
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp long), a row per row."""

    def make():
        def f(texts: pa.Array):
            return [pa.array([fingerprint((t or "").encode(), width) for t in texts.to_pylist()], pa.int64())]

        return f

    return map_text(docs, make, "fp long", text=text, carry=(id_col,))


def ball_links(distinct: DataFrame) -> DataFrame:
    """(u, v), v < u: links that connect exactly the fingerprints at a distance of at most 2. ``distinct`` has one row per fp."""
    ball = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(np.int64(np.uint64(1) << np.uint64(k)).item() if k < 63 else -(1 << 63)).cast("long")) for k in range(64)]]
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # rows grow 65-fold from here: spread them first
    emitted = distinct.repartition(parts, "fp").select("fp", F.explode(F.array(*ball)).alias("near"))
    least = F.min("fp").over(Window.partitionBy("near").orderBy("fp").rowsBetween(Window.unboundedPreceding, 0))
    met = emitted.select(F.col("fp").alias("u"), least.alias("v")).where("v < u")
    return met.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link, roots included.

    Alternates large-star (larger neighbours move to the smallest neighbour) and small-star (smaller neighbours do) until nothing moves. The minima
    are written before they are joined, so both sides of a join are plain shuffles and a hub's rows are split at run time.
    """
    edges = materialize(links.select("u", "v"))
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not now[0] or tuple(now) == state:
            break
        state = tuple(now)
        for large in (True, False):
            if large:
                both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            else:
                both = edges.select("u", "v")
            least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
            joined = both.join(least, "u")
            moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
            after = materialize(moved.where("u <> v").distinct())
            discard(edges, least)
            edges = after
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.toDF("node", "root"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp long, component): a row per row of ``docs``; component is the smallest id reachable over links, the row's own included."""
    prints = materialize(fingerprints(docs, width, id_col, text).toDF("id", "fp"))
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    found = materialize(components(ball_links(distinct.select("fp"))))
    linked = found.join(distinct.withColumnRenamed("fp", "node"), "node")
    least = materialize(linked.groupBy("root").agg(F.min("first").alias("component")))
    named = found.join(least, "root").select(F.col("node").alias("fp"), "component")
    label = materialize(distinct.join(named, "fp", "left").select("fp", "n", F.coalesce("component", "first").alias("component")))
    out = _labelled(prints, label)
    discard(found, least, distinct)
    return out.select(F.col("id").alias(id_col), "fp", "component")


def _labelled(prints: DataFrame, label: DataFrame) -> DataFrame:
    """Rows with their fingerprint's component. Fingerprints that hold more than one row in ``_HOT`` are fewer than ``_HOT``: their labels are sent to the rows, so
    a large group of copies is never one task; the other rows are shuffled to theirs."""
    total = label.agg(F.sum("n").alias("n"))  # one row
    hot = label.join(F.broadcast(total.withColumnRenamed("n", "_t"))).where(F.col("n") * _HOT > F.col("_t")).select(F.col("fp").alias("_f"), F.col("component").alias("_c"))
    told = prints.join(F.broadcast(hot), F.col("fp") == F.col("_f"), "left")
    rest = told.where("_f is null").select("id", "fp").join(label.select("fp", "component"), "fp").select("id", "fp", "component")
    return told.where("_f is not null").select("id", "fp", F.col("_c").alias("component")).unionByName(rest)


def keep_first(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; columns as they were. Of rows with the same id one stays.

    The rows that stay are semi-joined by id, and only ids that occur more than once need a look at whole rows. Rows with a null id go if another row of their
    group has an id; else one of them stays.
    """
    marked = materialize(near_duplicates(docs.select(id_col, text), width, id_col, text))
    stay = marked.where(F.col(id_col).eqNullSafe(F.col("component"))).select(F.col(id_col).alias("_i"), F.col("fp").alias("_f"))
    kept = docs.join(stay.select(F.col("_i").alias("_stay")).distinct(), F.col(f"`{id_col}`").eqNullSafe(F.col("_stay")), "left_semi")
    twice = marked.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1))
    many = materialize(twice.select(F.col(id_col).alias("_twice")))
    if not many.take(1):
        return kept
    again = F.col(f"`{id_col}`").eqNullSafe(F.col("_twice"))
    cols = list(docs.columns)
    rest = tuple(c for c in cols if c != text)
    prints = map_text(kept.join(many, again, "left_semi"), lambda: _print_and_text(width), "_fp long, _body string", text=text, carry=rest)
    row = F.struct(*[F.col("_body").alias(c) if c == text else F.col(f"`{c}`") for c in cols])
    one = prints.groupBy(F.col("_fp"), F.col(f"`{id_col}`").alias("_id")).agg(F.min(row).alias("_row"))
    one = one.join(stay.distinct(), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_fp") == F.col("_f")), "left_semi")
    return kept.join(many, again, "left_anti").unionByName(one.select("_row.*"))


def _print_and_text(width: int):
    return lambda t: [pa.array([fingerprint((x or "").encode(), width) for x in t.to_pylist()], pa.int64()), t.cast(pa.string())]
