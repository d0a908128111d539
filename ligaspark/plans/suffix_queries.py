"""Registered queries of suffix arrays over the benchmark's texts as sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import suffix_array
from . import derive
from .registry import query

_SUF = f"""genome AS ({derive.GENOME}), suf AS MATERIALIZED (SELECT name, i AS pos, substr(seq, i + 1) AS t FROM (SELECT name, seq, unnest(range(0, len(seq))) AS i FROM genome)),
sorted AS MATERIALIZED (SELECT row_number() OVER w - 1 AS ord, name, pos, t, coalesce(lag(t) OVER w, '') AS b, lag(name) OVER w AS prev FROM suf WINDOW w AS (ORDER BY t, name, pos)),
near AS MATERIALIZED (SELECT ord, name, pos, t, prev, CAST(coalesce(list_position(list_transform(range(1, least(len(t), len(b)) + 1), lambda i: substr(t, i, 1) <> substr(b, i, 1)), TRUE) - 1, least(len(t), len(b))) AS BIGINT) AS lcp FROM sorted)"""

#: Parts of reads, of 5 to 30 letters, as patterns.
_PATTERNS = "SELECT seqid AS pattern_id, substr(seq, CAST(1 + length(seq) % 4 AS INT), CAST(5 + CAST(substr(seqid, 2) AS BIGINT) % 26 AS INT)) AS pattern FROM reads"


@query("SELECT ord, name, pos, lcp FROM near", _SUF)
def suffix_order(s, d):
    """All suffixes in order, with what each has in common with the one before."""
    return suffix_array.suffix_array(suffix_array.ranks(derive.genome(s, d)))


@query("SELECT pattern_id, name, pos FROM patterns JOIN suf ON starts_with(t, pattern) WHERE pattern <> ''", _SUF, f"reads AS MATERIALIZED ({derive.GENOME_READS}), patterns AS MATERIALIZED ({_PATTERNS})")
def pattern_occurrences(s, d):
    """Every place of many patterns of many lengths, in one plan."""
    patterns = s.sql(_PATTERNS.replace("FROM reads", "FROM {reads}"), reads=derive.genome_reads(s, d))
    return suffix_array.occurrences(derive.genome(s, d), patterns)


@query("SELECT DISTINCT lcp AS length, substr(t, 1, lcp) AS sub FROM near WHERE name <> prev AND lcp = (SELECT max(lcp) FROM near WHERE name <> prev) AND lcp > 0", _SUF)
def longest_shared_substrings(s, d):
    """The longest substrings that at least two sequences have."""
    genome = derive.genome(s, d)
    length, places = suffix_array.longest_shared(suffix_array.ranks(genome))
    first = places.groupBy("item").agg(F.min(F.struct("name", "pos")).alias("p")).select("p.*")
    return first.join(genome, "name").select(F.lit(length).cast("long").alias("length"), F.substr("seq", (F.col("pos") + 1).cast("int"), F.lit(length)).alias("sub"))
