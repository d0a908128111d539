"""Column functions over nucleotide strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "ACGTacgt"
PAIRED = "TGCAtgca"


def reverse_complement(seq: Column) -> Column:
    """Reverse complement of A, C, G, T and N in either case; any other character becomes NUL."""
    known = F.regexp_replace(seq, "[^ACGTNacgtn]", "\\x00".encode().decode("unicode_escape"))
    return F.reverse(F.translate(known, BASES, PAIRED))


def reverse_complement_text(seq: str) -> str:
    table = dict(zip(map(ord, BASES), PAIRED, strict=True)) | {ord("N"): "N", ord("n"): "n"}
    return "".join(table.get(ord(c), "\0") for c in reversed(seq))


def compose_linkers(half_a: str, half_b: str | None = None) -> list[str]:
    """Full linkers of one or two half-linkers: AA, BB, AB, BA; a single one if there is no other half or both are the same."""
    rc = reverse_complement_text
    if not half_b or half_a == half_b:
        return [half_a + rc(half_a)]
    return [half_a + rc(half_a), half_b + rc(half_b), half_a + rc(half_b), half_b + rc(half_a)]


def site_starts(seq: Column, site: str) -> Column:
    """0-based starts of non-overlapping occurrences of ``site``, letters in either case, from left to right.

    The pieces between occurrences, split off without a limit, give the starts as running sums; nothing per position is evaluated.
    """
    pieces = F.split(F.upper(seq), site.upper(), -1)
    n = F.size(pieces) - 1
    step = F.aggregate(
        F.slice(pieces, F.lit(1), F.greatest(n, F.lit(0))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, p: F.struct((acc["at"] + F.length(p) + len(site)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(p))).alias("out")),
        lambda acc: acc["out"],
    )
    return step


def all_starts(seq: Column, pattern: str) -> Column:
    """0-based starts of every occurrence, overlapping ones too.

    The text is cut in front of each occurrence, and the pieces' lengths give the starts as running sums: a substring by position would walk the text from its
    beginning at every letter.
    """
    pieces = F.split(seq, f"(?=\\Q{pattern}\\E)", -1)
    first = F.when(F.startswith(seq, F.lit(pattern)), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        F.struct(F.lit(0).alias("at"), first.alias("out")),
        lambda acc, p: F.struct((acc["at"] + F.length(p)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(p))).alias("out")),
        lambda acc: acc["out"],
    )


def base_at(seq: Column) -> Column:
    """The characters of a string, one per element."""
    return F.filter(F.split(seq, ""), lambda c: c != "")


# The bases that each IUPAC letter stands for, as bits of A, C, G and T.
IUPAC = {"A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15, "X": 0}


def base_mask(base: Column, wild: bool = True) -> Column:
    """Bits of the bases that a letter stands for, in either case; 0 for any other character, and for ambiguous letters unless ``wild``."""
    some = {c: m for c, m in IUPAC.items() if wild or c in "ACGTU"}
    table = F.create_map(*[F.lit(x) for pair in some.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(base)), F.lit(0))


def prefix_agreement(ref: Column, query: Column, wildcard_ref: bool = False, wildcard_query: bool = False) -> Column:
    """struct<ref_start, ref_stop, query_start, query_stop, matches, cost>: both strings letter by letter over the shorter length, without gaps. IUPAC letters stand
    for their bases where asked for; else letters agree if they are the same."""
    n = F.least(F.length(ref), F.length(query))
    if wildcard_ref or wildcard_query:
        same = lambda a, b: base_mask(a, wildcard_ref).bitwiseAND(base_mask(b, wildcard_query)) != 0
    else:
        same = lambda a, b: a == b
    agree = F.filter(F.zip_with(base_at(ref), base_at(query), lambda a, b: a.isNotNull() & b.isNotNull() & same(a, b)), lambda x: x)
    matches = F.size(agree)
    zero = F.lit(0)
    return F.struct(zero.alias("ref_start"), n.alias("ref_stop"), zero.alias("query_start"), n.alias("query_stop"), matches.alias("matches"), (n - matches).alias("cost"))
