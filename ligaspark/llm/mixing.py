"""Mixing sources to target weights with a low-discrepancy schedule over equal-token blocks.

Each source's texts, shuffled by a keyed hash of the id, form one stream of words that begins again at its end. Block k of a source is words
k * block_tokens to (k + 1) * block_tokens of that endless stream, so every block has the same number of words whatever the source's size. Slot k of the mix
takes the golden-ratio point k * 0x9E3779B97F4A7C15 mod 2**64 and, through the sources' cumulative target shares, falls to a source; the slot's rank among its
source's slots names the block.

A source takes floor(target) words, no more and no less: a slot whose block lies past them takes nothing, the slot that crosses the end takes the rest, and a
source that has fewer slots than that needs (golden-ratio counts are off by a few) gets its missing ranks in closing slots after the schedule's last one.
Every slot counts for the words that it yields, so sources far smaller than a block meet their target too.

Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and share ``share`` of all words; a target stops at ``most`` times its source's size,
and the excess is shared anew by weight until none is above. That fixed point is min(most * size, level * weight) for one level.

Scale: the stream positions are prefix sums in two steps, within hash-prefix buckets of a source and over bucket totals, so a source that holds a third of
all rows is as many groups as its size needs. Rows alike in id, source and size are counted before they are moved, so an id that holds a third of all rows is
one row until its copies get their places. Slots are counted where they are made and only counts move; a chunk's slots are dealt to its sources in one pass. The driver holds one row per source, whose
number is checked against ``max_sources``, and only that table is broadcast. A very long text is one row of its source's stream, and as many rows of block
numbers as it has blocks; texts themselves are not read again after they are counted.

Size of a null text: 0. Null sources form one source. A null id is a key of its own. Repeated rows each take their place in the stream, equal keys in order of
id and size. Columns of the input with the names of results do not matter, as only id, text and source are read. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_TOKENS = 128
GOLDEN = 0x9E3779B97F4A7C15
MAX_SOURCES = 1_000_000
_ROWS_PER_BUCKET = 50_000
_CHUNK = 1 << 16
_SLOT_TASKS = 10_000
_PLACES = 4_096
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """Target of each source; ``sizes`` in the order of sources."""
    total = share * sum(sizes)
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / w[i], i))
    out = [0.0] * len(sizes)
    capped, rest, level = 0, sum(w), None
    for i in order:
        if level is None:
            now = (total - capped) / rest
            if most * sizes[i] <= now * w[i]:
                out[i] = float(most * sizes[i])
                capped += most * sizes[i]
                rest -= w[i]
                continue
            level = now
        out[i] = level * w[i]
    return out


def added(values: list[float]) -> float:
    """Left-to-right sum without compensation, which every engine gives alike."""
    run = 0.0
    for v in values:
        run += v
    return run


def thresholds(target: list[float]) -> np.ndarray:
    """Upper bounds, as 64-bit integers, of the sources' stretches of the unit interval; the last one is open."""
    total = added(target)
    out, run = [], 0.0
    for t in target[:-1]:
        run += t
        out.append(min(int(math.floor(run / total * 2.0**64)), 2**64 - 1) if total else 0)
    return np.array(out, dtype=np.uint64)


def source_of(slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    points = slots.astype(np.uint64) * np.uint64(GOLDEN)
    return np.searchsorted(bounds, points, side="right")


def slot_counts(spark: SparkSession, n_slots: int, bounds: np.ndarray) -> DataFrame:
    """(chunk long, s int, n long): slots of each source in each chunk of consecutive slots; made in parallel, no slot row is ever kept."""
    k = len(bounds) + 1

    def run(batches):
        for batch in batches:
            for c in batch.column(0).to_pylist():
                slots = np.arange(c * _CHUNK, min(n_slots, (c + 1) * _CHUNK), dtype=np.uint64)
                n = np.bincount(source_of(slots, bounds), minlength=k)
                s = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), c)), pa.array(s, pa.int32()), pa.array(n[s], pa.int64())], names=["chunk", "s", "n"])

    return spark.range(math.ceil(n_slots / _CHUNK)).mapInArrow(run, "chunk long, s int, n long")


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _key(id_col: Column, seed: str) -> Column:
    """Place in the shuffled order: hexadecimal digits of a hash of seed and id."""
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 16)


def sized(docs: DataFrame, seed: str, id_col: str, text: str, source: str, row: str | None = None) -> DataFrame:
    """(id, source, size, key) of every row, and ``row``, a digest of the whole row, where rows alike in id and size are to be told apart."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source).cast("string").alias("source"),
        _size(F.col(text)).alias("size"),
        _key(F.concat_ws(":", F.col(id_col).cast("string"), F.col(row)) if row else F.col(id_col), seed).alias("key"),
        *([F.col(row).alias("row")] if row else []),
    )


class Mix:
    """The mix of a table: ``docs`` (id, source, size, key, s, source_size, target, words, start) and the schedule behind it."""

    def __init__(self, docs: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_tokens: int = BLOCK_TOKENS, seed: str = "mix", id_col: str = "doc_id", text: str = "text", source: str = "source", max_sources: int = MAX_SOURCES, row: str | None = None):
        spark = self.spark = docs.sparkSession
        alike = sized(docs, seed, id_col, text, source, row)
        alike = alike.groupBy(*alike.columns).agg(F.count(F.lit(1)).alias("copies"))
        own, told = (["row"], ["row", "copies"]) if row else ([], [])
        rows = self._rows = materialize(alike.withColumn("all", F.col("size") * F.col("copies")))
        totals = rows.groupBy("source").agg(F.sum("all").alias("size"), F.count(F.lit(1)).alias("n"))
        found = totals.limit(max_sources + 1).collect()
        if len(found) > max_sources:
            raise ValueError(f"more than {max_sources} sources; raise max_sources if the driver can hold a row for each")
        found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        self.names = [r["source"] for r in found]
        self.sizes = [r["size"] for r in found]
        self.block_tokens, self.most, self.targets = block_tokens, most, targets(self.sizes, share, weights, most)
        self.words = [min(math.floor(t), most * z) for t, z in zip(self.targets, self.sizes, strict=True)]
        self.bounds = thresholds(self.targets)
        self.n_slots = math.ceil(added(self.targets) / block_tokens)
        counted = {r["s"]: r["n"] for r in slot_counts(spark, self.n_slots, self.bounds).groupBy("s").agg(F.sum("n").alias("n")).collect()} if self.n_slots else {}
        self.counted = [counted.get(i, 0) for i in range(len(found))]
        schema = T.StructType.fromDDL("source string, s int, source_size long, target double, words long")
        sources = spark.createDataFrame(list(zip(self.names, range(len(found)), self.sizes, self.targets, self.words, strict=True)), schema)
        digits = max(2, math.ceil(math.log(max(1, sum(r["n"] for r in found)) / _ROWS_PER_BUCKET, 16)) + 1) if found else 2
        rows = rows.withColumn("bucket", F.substring("key", 1, digits))
        named = rows.join(F.broadcast(sources.withColumnRenamed("source", "_src")), F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
        within = Window.partitionBy("s", "bucket").orderBy("key", "id", "size", *own).rowsBetween(Window.unboundedPreceding, -1)
        before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = rows.groupBy("source", "bucket").agg(F.sum("all").alias("z")).join(F.broadcast(sources.select(F.col("source").alias("_src"), "s")), F.col("source").eqNullSafe(F.col("_src")))
        offsets = offsets.select("s", "bucket", F.coalesce(F.sum("z").over(before), F.lit(0)).alias("offset"))
        placed = named.withColumn("within", F.coalesce(F.sum("all").over(within), F.lit(0))).join(offsets, ["s", "bucket"])
        placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_CHUNK}"))))
        placed = placed.withColumn("copy", F.explode(F.sequence(F.col("part") * _CHUNK, F.least("copies", (F.col("part") + 1) * _CHUNK) - 1)))
        start = F.col("within") + F.col("offset") + F.col("copy") * F.col("size")
        self.docs = placed.select("id", "source", "size", "key", "s", "source_size", "target", "words", start.alias("start"), *told)

    def schedule(self) -> DataFrame:
        """(slot, s, rank, words): every slot of the mix that yields words, the number of them, and the rank that names its block. Ranks come from counts per
        chunk of slots, never from one task per source; the closing slots, a few per source at most, come after the last one."""
        counts = slot_counts(self.spark, self.n_slots, self.bounds)
        before = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        tasks = min(max(1, math.ceil(self.n_slots / _CHUNK)), _SLOT_TASKS)  # stated, as a chunk's few rows stand for all of its slots
        starts = starts.select("chunk", "s", "base").repartition(tasks, "chunk").sortWithinPartitions("chunk", "s")
        words, bounds, n_slots, b = np.array(self.words, dtype=np.int64), self.bounds, self.n_slots, self.block_tokens

        def run(batches):
            at = None
            for batch in batches:
                chunk, s, base = (x.to_numpy() for x in batch.columns)
                cuts = [*np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk)]
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    if chunk[lo] != at:  # the chunk's slots by source, laid out once however many sources it has
                        at = int(chunk[lo])
                        slots = np.arange(at * _CHUNK, min(n_slots, (at + 1) * _CHUNK), dtype=np.uint64)
                        owner = source_of(slots, bounds)
                        by = np.argsort(owner, kind="stable")
                        slots, owner = slots[by].astype(np.int64), owner[by]
                    first = np.searchsorted(owner, s[lo:hi])
                    n = np.searchsorted(owner, s[lo:hi], side="right") - first
                    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    who, rank = np.repeat(s[lo:hi], n), np.repeat(base[lo:hi], n) + nth
                    left = np.minimum(b, words[who] - rank * b)
                    own = slots[np.repeat(first, n) + nth]
                    keep = left > 0
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (own, who, rank, left)], names=["slot", "s", "rank", "words"])

        kind = "slot long, s int, rank long, words long"
        closing, slot = [], n_slots
        for s, (have, w) in enumerate(zip(self.counted, self.words, strict=True)):
            for rank in range(have, -(-w // b)):
                closing.append((slot, s, rank, min(b, w - rank * b)))
                slot += 1
        made = starts.mapInArrow(run, kind)
        return made.union(self.spark.createDataFrame(closing, kind)) if closing else made

    def block_documents(self) -> DataFrame:
        """(s, rank, id, start, pass, first, n): which words of which text each block of the endless stream holds (first word, number of words), as far as the
        source's words go. ``start`` is the text's place in the stream, which tells it from all others that have words."""
        b = self.block_tokens
        rows = self.docs.where("size > 0").select("s", "id", "start", "size", "source_size", "words", F.explode(F.sequence(F.lit(0), F.lit(self.most - 1))).alias("pass"))
        rows = rows.withColumn("a", F.col("start") + F.col("pass") * F.col("source_size")).withColumn("z", F.least(F.col("a") + F.col("size"), F.col("words"))).where("a < z")
        rows = rows.withColumn("rank", F.explode(F.sequence(F.expr(f"a div {b}"), F.expr(f"(z - 1) div {b}"))))
        a, z = F.greatest("a", F.col("rank") * b), F.least("z", (F.col("rank") + 1) * b)
        return rows.select("s", "rank", "id", "start", "pass", (a - F.col("a")).alias("first"), (z - a).alias("n"))

    def mixed_blocks(self) -> DataFrame:
        """The mix itself: the schedule joined with the blocks' texts, a row for each slot and text part; order by slot and then by pass and start to read it
        in sequence."""
        return self.schedule().hint("merge").join(self.block_documents(), ["s", "rank"])  # Spark takes the schedule for as small as the numbers of its chunks

    def dealt(self) -> DataFrame:
        """``docs`` with ``taken`` as the slots deal it: the words of its parts in all blocks that slots name, summed per text."""
        self.settle()
        words = self.mixed_blocks().groupBy("s", "start").agg(F.sum("n").alias("dealt"))
        taken = F.when(F.col("size") > 0, F.coalesce("dealt", F.lit(0))).otherwise(0).cast("long").alias("taken")
        return self.docs.join(words, ["s", "start"], "left").select(*self.docs.columns, taken)

    def settle(self) -> None:
        """Writes ``docs``, and deletes the table of sizes that it came from."""
        self.docs = materialize(self.docs)
        discard(self._rows)

    def copies(self) -> DataFrame:
        """(row, copies, slot): for every copy of the texts of which the mix takes words, and every pass, the slot that names the block in which it begins. A copy
        that the source's last word cuts counts if at least half of it is taken. Needs the digests of rows (``row``)."""
        rows = self.docs.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(self.most - 1)))).withColumn("a", F.col("start") + F.col("pass") * F.col("source_size"))
        rows = rows.where((F.col("words") - F.col("a")) * 2 >= F.col("size")).where(F.col("a") < F.col("words"))
        rows = rows.withColumn("rank", F.expr(f"a div {self.block_tokens}"))
        return rows.join(self.schedule().select("s", "rank", "slot").hint("merge"), ["s", "rank"]).select("row", "copies", "slot")


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """Rows of ``docs``, whole, in the order of the schedule, as often as the mix takes them: a copy for each pass over its source's stream that reaches at
    least half of the text. A copy's place is the slot that names the block in which it begins, so sources interleave as the slots do, and each source's words
    are within one text of its target, whatever ids and sizes its rows share.

    A row is known by a digest of all its columns, so rows that share an id, or have none, take their own places. Rows alike in every column are one text that
    has the places of all of them; places of one row are dealt out by slot, ``_PLACES`` or so to a key, so many copies of a row are many keys. Texts are
    shuffled three times: to find the rows that are alike, to meet their slots and to be put in order. A text without words is in no block and goes.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    named = dict(zip(docs.columns, names, strict=True))
    own = docs.toDF(*names)
    own = own.withColumn("_row", F.md5(F.to_json(F.struct(*names))))
    mix = Mix(own, id_col=named[id_col], text=named[text], source=named[source], row="_row", **how)
    mix.settle()
    parts = F.expr(f"1 + (copies * {mix.most} - 1) div {_PLACES}")
    slots = materialize(mix.copies().select(F.col("row").alias("_at"), (F.col("slot") % parts).alias("_at_part"), "slot"))
    discard(mix.docs)
    texts = own.where(_size(F.col(named[text])) > 0).groupBy("_row").agg(*[F.first(c).alias(c) for c in names], F.count(F.lit(1)).alias("copies"))
    texts = texts.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    met = texts.join(slots, (F.col("_row") == F.col("_at")) & (F.col("_part") == F.col("_at_part")))
    return met.orderBy("slot", named[id_col], "_row").select(*names).toDF(*docs.columns)
