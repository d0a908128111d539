"""Reads to tag pairs: find the linker, cut the adapter, clip by length, rescue bases at the restriction site, and say what happened in a bit mask."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import locate_many
from ..genome import Site, parse_site

#: Bits of the mask.
UNLINKED, INTRA, NO_ADAPTER, ADDED_LEFT, ADDED_RIGHT, LEFT_SHORT, LEFT_LONG, RIGHT_SHORT, RIGHT_LONG = (1 << k for k in range(9))
INVALID = UNLINKED | LEFT_SHORT | RIGHT_SHORT

_END = "struct<seq:string,qual:string>"
_HIT = "struct<ref_start:int,ref_stop:int,query_start:int,query_stop:int,matches:int,cost:int>"
RESULT = f"seqid string, seq string, quality string, flag int, pet1 {_END}, pet2 {_END}, linker {_HIT}, adapter {_HIT}"


@dataclass(frozen=True)
class TrimConfig:
    """``mismatch`` and ``mismatch_adapter`` below 1 are shares of the length, else counts. ``explicit`` says that the linkers were given whole, which makes
    every linked read intra-molecular. ``last_linker`` takes the cut positions of the linker that was aligned last, rather than of the best one."""

    linkers: tuple[str, ...]
    site: Site = field(default_factory=lambda: parse_site("A^AGCTT"))
    mismatch: float = 0.12
    adapter: str = ""
    mismatch_adapter: float = 0.3
    shortest: int = 10
    longest: int = 22
    cut_len: int = 20
    explicit: bool = False
    last_linker: bool = False

    @property
    def linker_cost(self) -> int:
        return int(len(self.linkers[0]) * self.mismatch) if self.mismatch < 1 else int(self.mismatch)

    @property
    def adapter_cost(self) -> int:
        return int(len(self.adapter) * self.mismatch_adapter) if self.mismatch_adapter < 1 else int(self.mismatch_adapter)


def _find_linkers(reads: list[str], cfg: TrimConfig) -> tuple[np.ndarray, np.ndarray]:
    """Alignment and number of the linker of each read; number -1 if none is close enough. Reads with an exact hit never reach the aligner."""
    hit = np.full((len(reads), 6), -1, dtype=np.int32)
    which = np.full(len(reads), -1)
    cheapest = np.full(len(reads), 1 << 30)
    going = np.arange(len(reads))
    for k, linker in enumerate(cfg.linkers):
        at = np.array([reads[i].find(linker) for i in going], dtype=np.int64)
        exact, rest = going[at >= 0], going[at < 0]
        n = len(linker)
        for i, a in zip(exact, at[at >= 0], strict=True):
            hit[i] = (a, a + n, 0, n, n, 0)
        which[exact] = k
        if len(rest):
            got = locate_many([reads[i] for i in rest], linker)
            near = (got[:, 1] >= 0) & (got[:, 5] <= cfg.linker_cost)
            better = near & (got[:, 5] < cheapest[rest])
            unlinked = which[rest] < 0
            shown = np.ones(len(rest), bool) if cfg.last_linker else better | (unlinked & ~near)
            hit[rest[shown]] = got[shown]
            which[rest[better]] = k
            cheapest[rest[better]] = got[better, 5]
        going = rest
    return hit, which


def _hits(a: np.ndarray) -> pa.StructArray:
    """Alignments as structs; null where there is none."""
    names = ("ref_start", "ref_stop", "query_start", "query_stop", "matches", "cost")
    return pa.StructArray.from_arrays([pa.array(a[:, k], pa.int32()) for k in range(6)], names=names, mask=pa.array(a[:, 1] < 0))


def _end(seqs: list, quals: list) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(seqs, pa.string()), pa.array(quals, pa.string())], names=("seq", "qual"), mask=pa.array([s is None for s in seqs], pa.bool_()))


def trim_reads(reads: list[str], quals: list[str], cfg: TrimConfig) -> tuple:
    """Flags, both tags, and the linker's and the adapter's alignments of some reads. Bounds are computed for all reads at once; only the cuts are made one by one."""
    n = len(reads)
    hit, which = _find_linkers(reads, cfg)
    linked = which >= 0
    adapters = np.full((n, 6), -1, dtype=np.int32)
    n_ad = len(cfg.adapter)
    if n_ad and linked.any():
        adapters[linked] = locate_many([reads[i][hit[i, 1] :] for i in np.flatnonzero(linked).tolist()], cfg.adapter)
    flag = np.where(linked, 0, UNLINKED).astype(np.int32)
    flag[linked & ((len(cfg.linkers) == 1) | (which < 2) | cfg.explicit)] |= INTRA
    a, b, c = np.zeros(n, np.int64), hit[:, 0].astype(np.int64), hit[:, 1].astype(np.int64)
    z = np.array([len(r) for r in reads], dtype=np.int64)
    if n_ad:
        near = (adapters[:, 1] >= 0) & (adapters[:, 5].astype(np.float64) / n_ad < float(np.float32(cfg.adapter_cost / n_ad)))
        flag[linked & ~near] |= NO_ADAPTER
        at = c + adapters[:, 0]
        z = np.where(near & (at > 0), at, z)
    for short, long, lo, hi in ((LEFT_SHORT, LEFT_LONG, a, b), (RIGHT_SHORT, RIGHT_LONG, c, z)):
        size = hi - lo
        flag[linked & (size > cfg.longest)] |= long
        flag[linked & (size < cfg.shortest)] |= short
    a = np.where(b - a > cfg.longest, b - cfg.cut_len, a)
    z = np.where(z - c > cfg.longest, c + cfg.cut_len, z)
    left_mark, right_mark, site = cfg.site.left + cfg.site.middle, cfg.site.middle + cfg.site.right, cfg.site
    out = [[None] * n for _ in range(4)]
    for i, (lo, hi, lo2, hi2) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), z.tolist(), strict=True)):
        if not linked[i]:
            continue
        seq, qual = reads[i], quals[i]
        left, right, left_q, right_q = seq[lo:hi], seq[lo2:hi2], qual[lo:hi], qual[lo2:hi2]
        if left.endswith(left_mark):
            flag[i] |= ADDED_LEFT
            left, left_q = left + site.right, left_q + qual[-1:] * len(site.right)
        if right.startswith(right_mark):
            flag[i] |= ADDED_RIGHT
            right, right_q = site.left + right, qual[:1] * len(site.left) + right_q
        out[0][i], out[1][i], out[2][i], out[3][i] = left, left_q, right, right_q
    return flag, _end(out[0], out[1]), _end(out[2], out[3]), _hits(hit), _hits(adapters)


def trim(reads: DataFrame, cfg: TrimConfig) -> DataFrame:
    """(seqid, seq, quality, flag, pet1, pet2, linker, adapter), a row per read; one pass, no shuffle."""
    names = ["seqid", "seq", "quality", "flag", "pet1", "pet2", "linker", "adapter"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flag, *rest = trim_reads([r or "" for r in batch.column(1).to_pylist()], [q or "" for q in batch.column(2).to_pylist()], cfg)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flag), *rest], names=names)

    return reads.select("seqid", "seq", "quality").mapInArrow(run, RESULT)


def has(bit: int) -> Column:
    return F.col("flag").bitwiseAND(bit) != 0


def is_valid() -> Column:
    return F.col("flag").bitwiseAND(INVALID) == 0


def tag_pairs(trimmed: DataFrame, end: int) -> DataFrame:
    """FASTQ rows of one end of the valid reads."""
    return trimmed.where(is_valid()).select("seqid", F.col(f"pet{end}.seq").alias("seq"), F.col(f"pet{end}.qual").alias("quality"))


def flag_counts(flags: DataFrame) -> DataFrame:
    """The twelve counters of a run in one aggregate; those of bits count linked reads only."""
    linked = ~has(UNLINKED)
    bits = {"intra": INTRA, "adapter_unmatched": NO_ADAPTER, "added_left": ADDED_LEFT, "added_right": ADDED_RIGHT, "left_short": LEFT_SHORT, "left_long": LEFT_LONG, "right_short": RIGHT_SHORT, "right_long": RIGHT_LONG}
    return flags.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has(UNLINKED)).alias("unlinked"),
        F.count_if(linked & ~has(INTRA)).alias("inter"),
        F.count_if(is_valid()).alias("valid"),
        *[F.count_if(linked & has(b)).alias(n) for n, b in bits.items()],
    )


def length_distribution(trimmed: DataFrame) -> DataFrame:
    """(pet, length, count) over valid reads, after clipping and rescue."""
    long = trimmed.where(is_valid()).select(F.explode(F.array(*[F.struct(F.lit(k).alias("pet"), F.length(F.col(f"pet{k}.seq")).alias("length")) for k in (1, 2)])).alias("x"))
    return long.groupBy(F.col("x.pet").alias("pet"), F.col("x.length").alias("length")).agg(F.count(F.lit(1)).alias("count"))


def score_distribution(trimmed: DataFrame) -> DataFrame:
    """(part, score, count): matches less cost of the linker and adapter alignments of linked reads."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), (F.col(f"{p}.matches") - F.col(f"{p}.cost")).alias("score")) for p in ("linker", "adapter")])
    long = trimmed.where(~has(UNLINKED)).select(F.explode(parts).alias("x")).where("x.score is not null")
    return long.groupBy(F.col("x.part").alias("part"), F.col("x.score").alias("score")).agg(F.count(F.lit(1)).alias("count"))


def flag_table(trimmed: DataFrame) -> DataFrame:
    """The 18 text columns of a flag file; what is absent is a dot."""
    dot = lambda c: F.coalesce(c.cast("string"), F.lit("."))
    names = {"ref_start": "start", "ref_stop": "end", "query_start": "query_start", "query_stop": "query_end", "matches": "match", "cost": "cost"}
    of = lambda p: [dot(F.col(f"{p}.{k}")).alias(f"{p}_{v}") for k, v in names.items()]
    rest = F.when(~has(UNLINKED), F.expr("substring(seq, linker.ref_stop + 1, length(seq))"))
    return trimmed.select(F.col("seqid").alias("read_ID"), "flag", F.col("seq").alias("read_seq"), *of("linker"), dot(F.col("pet1.seq")).alias("PET1_seq"), dot(rest).alias("PET2_seq_with_adapter"), *of("adapter"), dot(F.col("pet2.seq")).alias("pet2_seq"))


# Parts of the same pipeline in Spark's own expressions, for reads whose linker occurs as it is.


def exact_split(reads: DataFrame, linker: str) -> DataFrame:
    """(seqid, pos, left, right): reads cut at the first exact linker; those without one have pos 0 and nulls."""
    pos, n = F.instr("seq", linker), len(linker)
    return reads.select("seqid", pos.cast("long").alias("pos"), F.when(pos > 0, F.expr("substring(seq, 1, pos0 - 1)".replace("pos0", f"instr(seq, '{linker}')"))).alias("left"), F.when(pos > 0, F.expr(f"substring(seq, instr(seq, '{linker}') + {n}, length(seq))")).alias("right"))


def clip(seq: Column, longest: int, cut_len: int, keep_end: bool) -> Column:
    """Too long tags keep ``cut_len`` bases, those next to the linker."""
    kept = F.right(seq, F.lit(cut_len)) if keep_end else F.left(seq, F.lit(cut_len))
    return F.when(F.length(seq) > longest, kept).otherwise(seq)


def rescue(seq: Column, site: Site, left: bool) -> Column:
    """Bases of the site that the cut took off are put back where the tag ends in what is left of it."""
    if left:
        return F.when(F.endswith(seq, F.lit(site.left + site.middle)), F.concat(seq, F.lit(site.right))).otherwise(seq)
    return F.when(F.startswith(seq, F.lit(site.middle + site.right)), F.concat(F.lit(site.left), seq)).otherwise(seq)
