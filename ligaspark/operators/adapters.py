"""Adapter inference, consensus sequences, base frequencies and quality encodings.

Reads are taken from a fixed start, where the adapter begins at the same place in most of them, and columns are compared without gaps, or
after a multiple alignment. If no column is conserved enough, the commonest k-mers are joined greedily instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..session import written
from . import suffix_array

ORDER = ("A", "T", "C", "G", "-")


def first_records(reads: DataFrame, n: int, order: str = "rec_idx") -> DataFrame:
    return reads.orderBy(order).limit(n)


_TOGETHER = 1_000_000  # letters counted at a time


def base_frequency(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """(pos, base, p): shares of A, T, C, G and gaps by column; N is left out. Letters are counted where they are, some at a time; only counts are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.full(256, len(ORDER), dtype=np.uint8)
        for k, b in enumerate(ORDER):
            codes[[ord(b), ord(b.lower())]] = k

        def counted(base: int, texts: list[str]) -> pa.RecordBatch:
            size = np.array([len(t) for t in texts])
            code = codes[np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)]
            pos = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
            known = code < len(ORDER)
            n = np.bincount(pos[known] * len(ORDER) + code[known])
            at = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array((at // len(ORDER) + base).astype(np.int32)), pa.array([ORDER[k] for k in (at % len(ORDER)).tolist()], pa.string()), pa.array(n[at].astype(np.int64))], names=["pos", "base", "n"])

        held, letters = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                for a in range(_TOGETHER, len(t), _TOGETHER):  # the rest of a long sequence, from its own positions on
                    yield counted(a, [t[a : a + _TOGETHER]])
                held.append(t[:_TOGETHER])
                letters += len(held[-1])
                if letters >= _TOGETHER:
                    yield counted(0, held)
                    held, letters = [], 0
        if held:
            yield counted(0, held)

    counts = seqs.select(F.col(seq).cast("string")).mapInArrow(run, "pos int, base string, n long").groupBy("pos", "base").agg(F.sum("n").alias("n"))
    return counts.select("pos", "base", (F.col("n") / F.sum("n").over(Window.partitionBy("pos"))).alias("p"))


def consensus(freq: DataFrame, threshold: float) -> DataFrame:
    """(pos, base): the first of A, T, C, G and gap whose share reaches the threshold, else N."""
    rank = F.array_position(F.array(*[F.lit(b) for b in ORDER]), F.col("base"))
    best = freq.groupBy("pos").agg(F.min_by("base", F.when(F.col("p") >= threshold, rank)).alias("base"))
    return best.select("pos", F.coalesce("base", F.lit("N")).alias("base"))


def joined(columns: DataFrame) -> DataFrame:
    """(consensus): columns in order as one string; as long as a read at most."""
    return columns.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("consensus"))


def longest_run(text):
    """Column: the longest stretch without N, gaps dropped; of equal ones the last."""
    runs = F.transform(F.split(text, "N"), lambda r, i: F.struct(F.length(F.replace(r, F.lit("-"), F.lit(""))).alias("n"), i.alias("i"), F.replace(r, F.lit("-"), F.lit("")).alias("run")))
    return F.array_max(runs)["run"]


_TOGETHER_SEQS, _ARITY = 64, 16  # different sequences that are aligned in one group, and profiles that are merged in one


def aligned_frequency(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """(pos, base, p): shares of A, T, C, G and gaps in the columns of a multiple alignment of any number of sequences; N is left out.

    Equal sequences are counted first. The different ones are dealt by a hash to groups of about ``_TOGETHER_SEQS``; in each, the commonest is aligned with the next
    one, and so on, and the groups' profiles are merged in a tree, ``_ARITY`` at a time. What moves are profiles, as wide as a sequence, and each level is written.
    Groups and orders follow from the sequences alone, so reruns agree. Null and empty sequences take no part; none at all give no rows.
    """
    distinct = written(seqs.select(F.col(seq).cast("string").alias("s")).where("s <> ''").groupBy("s").agg(F.count(F.lit(1)).alias("n")))
    groups = -(-distinct.count() // _TOGETHER_SEQS)
    if not groups:
        return seqs.sparkSession.createDataFrame([], "pos int, base string, p double")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.select(["s", "n", "g"]).to_pylist()), key=lambda r: (-r["n"], r["s"]))
        yield _merge(rows[0]["g"], [(profiles.of_sequence(r["s"], r["n"]), r["n"]) for r in rows])

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["g"])
        yield _merge(rows[0]["up"], [(np.frombuffer(r["columns"], np.int64).reshape(-1, 5), r["n"]) for r in rows])

    schema = "g long, n long, columns binary"
    level = written(distinct.withColumn("g", F.pmod(F.xxhash64("s"), F.lit(groups))).groupBy("g").applyInArrow(begin, schema))
    while groups > 1:
        groups = -(-groups // _ARITY)
        level = written(level.withColumn("up", F.expr(f"g div {_ARITY}")).groupBy("up").applyInArrow(go_on, schema))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["columns"], np.int64).reshape(-1, 5)
                total = counts.sum(axis=1)
                at, k = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([profiles.LETTERS[i] for i in k.tolist()], pa.string()), pa.array(counts[at, k] / total[at])], names=["pos", "base", "p"])

    return level.mapInArrow(shares, "pos int, base string, p double")


def _merge(group: int, parts: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
    columns, n = parts[0]
    for other, m in parts[1:]:
        columns = profiles.merged(columns, n, other, m)
        n += m
    return pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([n], pa.int64()), pa.array([columns.tobytes()], pa.binary())], names=["g", "n", "columns"])


def infer_adapter(reads: DataFrame, n: int = 1000, start: int = 70, threshold: float = 0.75, order: str = "rec_idx", k: int = 12, align: bool = False) -> str:
    """The conserved sequence that begins at ``start`` in the first ``n`` reads; "" if there is none. ``align``: columns are those of a multiple alignment."""
    few = first_records(reads, n, order).select(F.expr(f"substring(seq, {start + 1}, length(seq))").alias("seq")).where("seq <> ''")
    row = joined(consensus(aligned_frequency(few) if align else base_frequency(few), threshold)).select(longest_run(F.col("consensus")).alias("run")).first()
    run = row["run"] or ""
    if len(run) >= k:
        return run
    kmers = few.select(F.expr(f"transform(sequence(1, greatest(length(seq) - {k} + 1, 1)), i -> substring(seq, i, {k}))").alias("m"))
    counts = kmers.select(F.explode("m").alias("m")).where(F.length("m") == k).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    least = (counts.agg(F.max("n").alias("n")).first()["n"] or 0) * threshold
    rows = counts.where(F.col("n") >= least).collect()  # all that grow() can step to
    return grow({r["m"]: r["n"] for r in rows}, k, threshold) or run


def grow(counts: dict[str, int], k: int, threshold: float) -> str:
    """The commonest k-mer, extended at both ends while the next one is nearly as common."""
    if not counts:
        return ""
    seed = max(counts, key=lambda m: (counts[m], m))
    least, out, seen = counts[seed] * threshold, seed, {seed}
    while True:
        right = max(((counts.get(out[-k + 1 :] + b, 0), b) for b in "ACGT"))
        if right[0] < least or out[-k + 1 :] + right[1] in seen:
            break
        seen.add(out[-k + 1 :] + right[1])
        out += right[1]
    while True:
        left = max(((counts.get(b + out[: k - 1], 0), b) for b in "ACGT"))
        if left[0] < least or left[1] + out[: k - 1] in seen:
            return out
        seen.add(left[1] + out[: k - 1])
        out = left[1] + out


# ---------------------------------------------------------------- quality encodings

# Ranges of ASCII codes of the known encodings, and their offsets.
ENCODINGS = {"Sanger": (33, 73, 33), "Illumina-1.8": (33, 74, 33), "Solexa": (59, 104, 64), "Illumina-1.3": (64, 104, 64), "Illumina-1.5": (66, 105, 64)}


def quality_range(reads: DataFrame) -> DataFrame:
    """One row: lowest and highest code of all quality symbols."""
    codes = F.transform(F.filter(F.split("quality", ""), lambda c: c != ""), lambda c: F.ascii(c))
    return reads.select(F.array_min(codes).alias("a"), F.array_max(codes).alias("z")).agg(F.min("a").alias("lowest"), F.max("z").alias("highest"))


def possible_encodings(lowest: int, highest: int) -> list[str]:
    return [n for n, (a, z, _) in ENCODINGS.items() if a <= lowest and highest <= z]


def common_symbols(reads: DataFrame, n: int = 4) -> DataFrame:
    rows = reads.select(F.explode(F.filter(F.split("quality", ""), lambda c: c != "")).alias("symbol"))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "symbol").limit(n)


def infer_phred(reads: DataFrame, default: int = 33) -> int:
    """33 or 64 by the encodings that fit all symbols, over the whole input; ``default`` if that does not single one out.

    Illumina 1.5 does not use the codes 64 and 65, and marks bad tails with B: a B among the four commonest symbols speaks for it alone.
    """
    row = quality_range(reads).first()
    if row["lowest"] is None:
        return default
    fit = possible_encodings(row["lowest"], row["highest"])
    if "Illumina-1.5" in fit and "B" in [r["symbol"] for r in common_symbols(reads).collect()]:
        fit = ["Illumina-1.5"]
    return ENCODINGS[fit[0]][2] if len(fit) == 1 else default


# ---------------------------------------------------------------- common substrings


def common_substrings(seqs: DataFrame, length: int, seq: str = "seq") -> DataFrame:
    """(sub): substrings of a length that every row has; a null row has none. A task keeps those of its first row that all of its rows have, so only a row's
    substrings leave it, and what all tasks with rows have is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            texts = batch.column(0)
            if not len(texts):
                continue
            if held is None:
                first = texts[0].as_py() or ""
                held = sorted({first[i : i + length] for i in range(len(first) - length + 1)})
            held = [c for c in held if not texts.null_count and pc.all(pc.match_substring(texts, c)).as_py()]
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([None, *held], pa.string())], names=["sub"])  # the null counts the task

    found = seqs.select(F.col(seq).cast("string")).mapInArrow(run, "sub string").groupBy("sub").agg(F.count(F.lit(1)).alias("k"))
    every = found.agg(F.max(F.when(F.col("sub").isNull(), F.col("k"))).alias("n"), F.collect_list(F.struct("sub", "k")).alias("all"))  # a row's substrings for each task
    return every.select(F.explode(F.filter("all", lambda x: x["sub"].isNotNull() & (x["k"] == F.col("n")))).alias("x")).select("x.sub")


def longest_common_substring(seqs: DataFrame, seq: str = "seq") -> str:
    """The longest substring of all rows, by names of substrings (:mod:`suffix_array`). Ties go to the one that sorts first; a null or empty row leaves nothing."""
    n = seqs.count()
    if not n:
        return ""
    found = suffix_array.ranks(seqs.select(F.monotonically_increasing_id().alias("name"), seq), "name", seq)
    best = suffix_array.longest_common(found, n)
    found.discard()
    return best
