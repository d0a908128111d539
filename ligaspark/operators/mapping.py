"""Mapping reads to sequences with up to k differences (substitutions, insertions and deletions), as joins.

Of ``k + 1`` seeds of a read that do not overlap, one at least is in every place that differs from the read by ``k`` or less (the pigeonhole principle), moved by ``k``
letters at most. So the seeds of both strands are joined with an index of all words of the sequences; what they point to is fetched from the sequences, cut
into bins, and compared by Levenshtein distance with a bound, for every start and length that is possible. All of it is exact: no seed is left out for being common.

A read's placements are those with its least number of differences; the first by name, start, end and strand is reported. It is unique (``mapq`` 37) if all of
them are on one strand of one sequence with starts within ``k`` letters, else ``mapq`` is 0. Reads of fewer than ``LEAST`` letters per seed, and those that are
nowhere within ``k``, are unmapped (flag 4, ``*``, -1). Letters count in either case; others than A, C, G and T are in no seed but may be compared.

The index is two tables in the shared folder: words (code, name, pos) and bins of text. Only candidates move in a query: a seed's rows are those of its word, and a
word that is everywhere is split by Spark's skew join.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement
from ..session import written

WORD, LEAST, BIN = 12, 6, 256
UNIQUE_MAPQ = 37
_CODE = np.full(256, 4, dtype=np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i


def word_codes(text: bytes, q: int) -> np.ndarray:
    """Two bits a letter for the word that begins at each place; -1 where it holds another letter."""
    c = _CODE[np.frombuffer(text, np.uint8)].astype(np.int64)
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    for i in range(q):
        out = out * 4 + (c[i : i + n] & 3)
    other = np.concatenate([[0], np.cumsum(c == 4)])
    out[other[q:] > other[:-q]] = -1
    return out


def bins(sequences: DataFrame, overlap: int, width: int = BIN) -> DataFrame:
    """(name, bin, text): the letters from ``bin * width`` on, ``width + overlap`` of them, from pieces (name, start, seq) of sequences. Pieces are cut as bytes,
    which takes no walk from their beginning."""
    raw, a = F.upper("seq").cast("binary"), F.col("start").cast("long")
    rows = sequences.where("seq <> ''").select("name", a.alias("a"), (a + F.length("seq")).alias("z"), raw.alias("raw"))
    rows = rows.withColumn("bin", F.explode(F.sequence(F.greatest(F.floor((F.col("a") - overlap - width + 1) / width), F.lit(0)), F.floor((F.col("z") - 1) / width))))
    lo, hi = F.greatest("a", F.col("bin") * width), F.least("z", (F.col("bin") + 1) * width + overlap)
    parts = rows.where(lo < hi).select("name", "bin", F.struct(lo.alias("at"), F.substring(F.col("raw"), (lo - F.col("a") + 1).cast("int"), (hi - lo).cast("int")).cast("string").alias("t")).alias("p"))
    return parts.groupBy("name", "bin").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["t"]), "").alias("text"))


class Index:
    """Words and text of sequences, for reads of up to ``longest`` letters and up to ``most`` differences."""

    def __init__(self, sequences: DataFrame, longest: int, most: int, q: int = WORD):
        self.longest, self.most, self.q = longest, most, q
        self.bins = written(bins(sequences, longest + 4 * most + q))
        inner = self.bins.select("name", "bin", "text")

        def run(batches):
            for batch in batches:
                codes, names, at = [], [], []
                for i, (b, t) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                    c = word_codes(t.encode("latin-1", "replace")[: BIN + q - 1], q)
                    good = np.flatnonzero(c >= 0)
                    codes.append(c[good])
                    at.append(b * BIN + good)
                    names.append(np.full(len(good), i))
                if codes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(codes)), batch.column(0).take(pa.array(np.concatenate(names))), pa.array(np.concatenate(at).astype(np.int64))], names=["code", "name", "pos"])

        self.words = written(inner.mapInArrow(run, "code long, name string, pos long"))

    def seeds(self, reads: DataFrame, k: int) -> DataFrame:
        """(rid, strand, seq, off, code) of reads (rid, seq): the first letters of each of ``k + 1`` equal parts, on both strands."""
        both = reads.select("rid", F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.upper("seq").alias("seq")), F.struct(F.lit("-").alias("strand"), F.upper(reverse_complement(F.col("seq"))).alias("seq")))).alias("x")).select("rid", "x.*")
        q = self.q

        def run(batches):
            for batch in batches:
                row, off, code = [], [], []
                for i, s in enumerate(batch.column(2).to_pylist()):
                    c = word_codes(s.encode("latin-1", "replace"), q)
                    step = len(s) // (k + 1)
                    for a in range(0, step * (k + 1), step):
                        if a < len(c) and c[a] >= 0:
                            row.append(i), off.append(a), code.append(int(c[a]))
                part = batch.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(off, pa.int32()), pa.array(code, pa.int64())], names=["rid", "strand", "seq", "off", "code"])

        return both.mapInArrow(run, "rid long, strand string, seq string, off int, code long")

    def map(self, reads: DataFrame, k: int) -> DataFrame:
        """Alignments (read_id, flag, rname, pos, end_pos, mapq, seq, qual, differences) of reads (seqid, seq, quality), a row per read."""
        if k > self.most:
            raise ValueError(f"the index is for {self.most} differences")
        known = written(reads.select(F.monotonically_increasing_id().alias("rid"), "seqid", F.coalesce("seq", F.lit("")).alias("seq"), "quality"))
        size = known.agg(F.max(F.length("seq")).alias("n")).first()["n"] or 0
        if size > self.longest:
            raise ValueError(f"a read has {size} letters; the index is for {self.longest}")
        fit = known.where(F.length("seq") >= max(self.q, LEAST) * (k + 1)).select("rid", "seq")
        at = self.seeds(fit, k).join(self.words, "code").select("rid", "strand", "seq", "name", (F.col("pos") - F.col("off")).alias("d")).distinct()
        at = at.withColumn("from", F.greatest(F.col("d") - k, F.lit(0))).where("d + length(seq) > 0").withColumn("bin", F.floor(F.col("from") / BIN))
        at = at.join(self.bins, ["name", "bin"])
        n, base = F.length("seq"), F.col("bin") * BIN
        places = F.expr(f"explode(flatten(transform(sequence(`from`, d + {k}), a -> transform(sequence(length(seq) - {k}, length(seq) + {k}), m -> struct(a AS a, m AS m)))))")
        at = at.where(F.col("from") <= F.col("d") + k).select("rid", "strand", "name", "seq", "text", base.alias("base"), places.alias("x")).where("x.m > 0 and x.a - base + x.m <= length(text)")
        window = F.substring(F.col("text"), (F.col("x.a") - F.col("base") + 1).cast("int"), F.col("x.m").cast("int"))
        found = at.select("rid", "strand", "name", F.col("x.a").alias("a"), (F.col("x.a") + F.col("x.m")).alias("z"), F.levenshtein(window, F.col("seq"), k).alias("diff")).where("diff >= 0").distinct()
        place = F.struct("name", "a", "z", "strand")
        per = found.groupBy("rid", "diff").agg(F.min(place).alias("place"), (F.min("name").eqNullSafe(F.max("name")) & (F.min("strand") == F.max("strand")) & (F.max("a") - F.min("a") <= k)).alias("lone"))
        best = per.groupBy("rid").agg(F.min(F.struct("diff", "place", "lone")).alias("b"))
        out, b = known.join(best, "rid", "left"), F.col("b.place")
        none = F.col("b").isNull()
        return out.select(
            F.col("seqid").alias("read_id"), F.when(none, 4).when(b["strand"] == "-", 16).otherwise(0).alias("flag"), F.when(none, "*").otherwise(b["name"]).alias("rname"),
            F.when(none, -1).otherwise(b["a"]).alias("pos"), F.when(none, -1).otherwise(b["z"]).alias("end_pos"), F.when(F.coalesce("b.lone", F.lit(False)), UNIQUE_MAPQ).otherwise(0).alias("mapq"),
            "seq", F.col("quality").alias("qual"), F.col("b.diff").alias("differences"),
        )

    def aligner(self) -> Callable[[DataFrame, int], DataFrame]:
        """For ``alignments.iterate``: round i maps with up to i differences."""
        return lambda reads, i: self.map(reads, i)
