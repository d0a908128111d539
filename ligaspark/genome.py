"""Genomes as small driver-side facts: chromosome lengths, restriction sites, regions, resolutions and units."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import CHROM_SIZES

# Lengths of the chromosomes of four public assemblies, in the order of their files.
PRESETS = {
    "hg19": "chr1 249250621 chr2 243199373 chr3 198022430 chr4 191154276 chr5 180915260 chr6 171115067 chr7 159138663 chr8 146364022 chr9 141213431 chr10 135534747 chr11 135006516 chr12 133851895 chr13 115169878 chr14 107349540 chr15 102531392 chr16 90354753 chr17 81195210 chr18 78077248 chr19 59128983 chr20 63025520 chr21 48129895 chr22 51304566 chrX 155270560 chrY 59373566",
    "hg38": "chr1 248956422 chr2 242193529 chr3 198295559 chr4 190214555 chr5 181538259 chr6 170805979 chr7 159345973 chr8 145138636 chr9 138394717 chr11 135086622 chr10 133797422 chr12 133275309 chr13 114364328 chr14 107043718 chr15 101991189 chr16 90338345 chr17 83257441 chr18 80373285 chr19 58617616 chr20 64444167 chr21 46709983 chr22 50818468 chrX 156040895 chrY 57227415",
    "mm9": "chr1 197195432 chr2 181748087 chr3 159599783 chr4 155630120 chr5 152537259 chr6 149517037 chr7 152524553 chr8 131738871 chr9 124076172 chr10 129993255 chr11 121843856 chr12 121257530 chr13 120284312 chr14 125194864 chr15 103494974 chr16 98319150 chr17 95272651 chr18 90772031 chr19 61342430 chrX 166650296 chrY 15902555",
    "mm10": "chr1 195471971 chr2 182113224 chr3 160039680 chr4 156508116 chr5 151834684 chr6 149736546 chr7 145441459 chr8 129401213 chr9 124595110 chr10 130694993 chr11 122082543 chr12 120129022 chr13 120421639 chr14 124902244 chr15 104043685 chr16 98207768 chr17 94987271 chr18 90702639 chr19 61431566 chrX 171031299 chrY 91744698",
}


def supported_chromosomes() -> list[str]:
    return sorted(PRESETS)


def chromosome_sizes(spark: SparkSession, which: str | list[tuple[str, int]]) -> DataFrame:
    """(chrom, length, ord): a preset by name, or the given names and lengths."""
    if isinstance(which, str):
        if which not in PRESETS:
            raise ValueError(f"no preset {which}; there are {', '.join(supported_chromosomes())}")
        words = PRESETS[which].split()
        which = list(zip(words[::2], map(int, words[1::2]), strict=True))
    return spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(which)], CHROM_SIZES)


def preset_lines(which: str) -> str:
    """A preset as the text of a chromosome file: a name and a length on each line."""
    if which not in PRESETS:
        raise ValueError(f"no preset {which}; there are {', '.join(supported_chromosomes())}")
    words = PRESETS[which].split()
    return "".join(f"{c}\t{n}\n" for c, n in zip(words[::2], words[1::2], strict=True))


def natural_key(chrom: Column) -> list[Column]:
    """Sort columns for "version" order: names without digits after those with, numbers by value."""
    head, digits = F.regexp_extract(chrom, r"^(\D*)", 1), F.regexp_extract(chrom, r"(\d+)", 1)
    return [head.asc(), F.when(digits == "", F.lit(None)).otherwise(digits.cast("long")).asc_nulls_last(), chrom.asc()]


def toggle_chr(chrom: Column) -> Column:
    """chr1 <-> 1."""
    return F.when(chrom.startswith("chr"), F.substring(chrom, 4, 1_000_000)).otherwise(F.concat(F.lit("chr"), chrom))


def with_chr(chrom: Column) -> Column:
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def is_main(chrom: Column) -> Column:
    """Numbered chromosomes and X, with or without the prefix."""
    return F.rlike(chrom, F.lit(r"^(chr)?([0-9]+|X)$"))


@dataclass(frozen=True)
class Site:
    """A restriction site: its letters, and where the strand is cut."""

    seq: str
    cut: int

    @property
    def left(self) -> str:
        return self.seq[: self.cut]

    @property
    def middle(self) -> str:
        return self.seq[self.cut : -self.cut]

    @property
    def right(self) -> str:
        return self.seq[-self.cut :]


def parse_site(text: str) -> Site:
    """``T^TAA`` or ``T*TAA``; the first mark is the cut, all marks go."""
    marks = [i for i, c in enumerate(text) if c in "^*"]
    if not marks:
        raise ValueError(f"no ^ or * in {text}")
    seq = re.sub(r"[\^*]", "", text)
    cut = marks[0]
    if not 0 < cut <= len(seq) / 2:
        raise ValueError(f"the cut of {text} must lie in the first half of the site, after its first base")
    return Site(seq, cut)


@dataclass(frozen=True)
class Region:
    """A stretch of a chromosome; without bounds, all of it."""

    chrom: str
    start: int | None = None
    end: int | None = None

    def __post_init__(self):
        if (self.start is None) != (self.end is None):
            raise ValueError("a region has both bounds or none")
        if self.start is not None and not 0 <= self.start <= self.end:
            raise ValueError(f"bounds out of order: {self.start}-{self.end}")

    def __contains__(self, other: Region) -> bool:
        if self.chrom != other.chrom:
            return False
        return self.start is None or (other.start is not None and self.start <= other.start and other.end <= self.end)

    def __str__(self) -> str:
        return self.chrom if self.start is None else f"{self.chrom}:{self.start}-{self.end}"

    def holds(self, chrom: Column, pos: Column) -> Column:
        here = chrom == self.chrom
        return here if self.start is None else here & (pos >= self.start) & (pos < self.end)

    def overlaps(self, chrom: Column, start: Column, end: Column) -> Column:
        here = chrom == self.chrom
        return here if self.start is None else here & (start <= self.end) & (end >= self.start)


def parse_region(text: str) -> Region:
    """``chr1``, ``chr1:1,000-2,000`` or ``chr1 1000 2000``; thousands marks and stray punctuation are dropped."""
    words = re.split(r"[\s:-]+", re.sub(r"[,.;|!{}()]", "", text).strip())
    if len(words) == 1 and words[0]:
        return Region(words[0])
    if len(words) == 3 and words[1].isdigit() and words[2].isdigit():
        return Region(words[0], int(words[1]), int(words[2]))
    raise ValueError(f"not a region: {text}")


def choose_resolution(length: int, resolutions: list[int], bins: int = 500) -> int:
    """The coarsest resolution, going up, that still gives at least ``bins`` bins; the finest if none does."""
    best = min(resolutions)
    for r in sorted(resolutions):
        if length // r < bins:
            break
        best = r
    return best


def proper_unit(n: Column) -> Column:
    """2500000 -> 2M500K, 3000000 -> 3M, 500 -> 0K: whole millions and thousands; what is below a thousand is left out."""
    m, k = F.floor(n / 1_000_000), F.floor(n % 1_000_000 / 1_000)
    millions, thousands = F.concat(m.cast("string"), F.lit("M")), F.concat(k.cast("string"), F.lit("K"))
    return F.when(m == 0, thousands).when(k == 0, millions).otherwise(F.concat(millions, thousands))
