"""The driver's tables as contacts, sites, alignments and reads: the same SQL text for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITE_LEN = 4
LINKER = "GTCGGATCCTAAGCGCTTAGGATCCGAC"
ADAPTER = "AGATCGGAAGAGCACACGTC"

SITES = "SELECT DISTINCT concat('chr', p_partkey % 5 + 1) AS chrom, p_partkey * 97 + (p_size * 13) % 89 AS pos FROM part"

#: Sites without those of one chromosome, whose contacts have no fragments then.
SOME_SITES = SITES + " WHERE p_partkey % 5 <> 4"

CONTACTS = """
SELECT concat('chr', c1) AS chr1, s1 AS start1, s1 + 20 AS end1, concat('chr', c2) AS chr2,
  CASE WHEN s2 < 0 THEN 0 ELSE s2 END AS start2, CASE WHEN s2 < 0 THEN 20 ELSE s2 + 20 END AS end2,
  name, 0 AS score, st1 AS strand1, st2 AS strand2
FROM (SELECT concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, '_', CAST(round(l_extendedprice * 100) AS BIGINT)) AS name,
  l_partkey % 5 + 1 AS c1, l_partkey * 97 + (l_linenumber % 3) * 41 AS s1,
  CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey % 5 + 1 ELSE l_partkey % 5 + 1 END AS c2,
  l_partkey * 97 + CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT) * 7 - 300 AS s2,
  CASE WHEN l_returnflag = 'N' THEN '+' ELSE '-' END AS st1, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS st2 FROM lineitem) b"""

ALIGNMENTS = """
SELECT concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS read_id,
  CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END AS flag,
  concat('chr', l_partkey % 5 + 1) AS rname, l_partkey * 97 AS pos, l_partkey * 97 + 20 AS end_pos, l_suppkey % 38 AS mapq FROM lineitem"""

#: Whole texts as sequences, a row per document; without a letter, an empty one.
WHOLE = """
SELECT concat('q', doc_id) AS seqid, doc_id AS rec_idx,
  translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''/*g*/)), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents"""

#: Whole texts cut into reads, the short rest included, so that every letter is in one read: of every fourth document plain pieces of 90 letters, of the others a
#: linker after the first ``l`` letters of each piece and an adapter at its end. DuckDB only; Spark has ``tiles``.
TILES = f"""
SELECT concat(seqid, '_', k) AS seqid, doc_id * 1000000000 + k AS rec_idx,
  CASE WHEN doc_id % 4 = 0 THEN substr(seq, 1 + k * w, w) ELSE concat(substr(seq, 1 + k * w, l), '{LINKER}', substr(seq, 1 + k * w + l, w - l), '{ADAPTER}') END AS seq
FROM (SELECT *, unnest(range(0, (length(seq) + w - 1) // w)) AS k
 FROM (SELECT seqid, rec_idx AS doc_id, seq, 8 + rec_idx % 19 AS l, CASE WHEN rec_idx % 4 = 0 THEN 90 ELSE 16 + rec_idx % 19 + rec_idx % 17 END AS w FROM ({WHOLE}) e) f) g"""

#: The same with a linker and an adapter in every piece.
LINKED = TILES.replace("doc_id % 4 = 0", "FALSE").replace("rec_idx % 4 = 0", "FALSE")

#: The benchmark's texts as sequences of a small genome.
GENOME = """
SELECT concat('b', item_id) AS name, item_id,
  translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''/*g*/)), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM benchmark"""

#: A read for each supplier: 30 letters of a sequence of that genome with up to two substitutions, or a deletion, or an insertion, or letters from nowhere; some from the other strand.
GENOME_READS = """
SELECT seqid, CASE WHEN turned THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq FROM (SELECT seqid, turned, CASE kind
  WHEN 0 THEN t WHEN 1 THEN concat(substr(t, 1, 9), translate(substr(t, 10, 1), 'ACGT', 'CGTA'), substr(t, 11))
  WHEN 2 THEN concat(substr(t, 1, 4), translate(substr(t, 5, 1), 'ACGT', 'GTAC'), substr(t, 6, 13), translate(substr(t, 19, 1), 'ACGT', 'TACG'), substr(t, 20))
  WHEN 3 THEN concat(substr(t, 1, 14), substr(t, 16)) WHEN 4 THEN concat(substr(t, 1, 14), 'A', substr(t, 15)) ELSE substr(repeat('ACCGTTGACA', 4), 1 + k % 7, 30) END AS seq
 FROM (SELECT concat('s', s_suppkey) AS seqid, s_suppkey AS k, s_suppkey % 6 AS kind, s_suppkey % 7 = 0 AS turned, substr(seq, CAST(1 + s_suppkey * 7919 % (length(seq) - 40) AS INT), 30) AS t
  FROM (SELECT s_suppkey, s_suppkey % (SELECT count(*) FROM genome WHERE length(seq) > 60) AS i FROM supplier) a
  JOIN (SELECT seq, row_number() OVER (ORDER BY item_id) - 1 AS i FROM genome WHERE length(seq) > 60) b USING (i)) c) d"""

#: Chromosomes of the derived tables; long enough for every position.
SIZES = [(f"chr{k}", 20_000_000) for k in range(1, 6)]


def duck(sql: str) -> str:
    return sql.replace("''/*g*/", "'', 'g'")


def _run(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    return spark.sql(sql.replace("/*g*/", "").replace(f"FROM {table}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def sites(spark: SparkSession, sf_dir: str, some: bool = False) -> DataFrame:
    return _run(spark, sf_dir, SOME_SITES if some else SITES, "part")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CONTACTS, "lineitem")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ALIGNMENTS, "lineitem")


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, GENOME, "benchmark")


def genome_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = GENOME_READS.replace("FROM genome", "FROM {genome}").replace("FROM supplier", "FROM {supplier}")
    return spark.sql(sql, genome=genome(spark, sf_dir), supplier=spark.read.parquet(f"{sf_dir}/supplier.parquet"))


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, WHOLE, "documents")


def tiles(spark: SparkSession, sf_dir: str, linked: bool = False) -> DataFrame:
    """The rows of TILES, or of LINKED; one pass of a pattern over each text, as a substring by position walks the text from its beginning."""
    doc = F.col("rec_idx")
    left = 8 + doc % 19
    plain = F.lit(False) if linked else doc % 4 == 0
    width = F.when(plain, 90).otherwise(left + 8 + doc % 17)
    cut = whole(spark, sf_dir).select("seqid", "rec_idx", F.posexplode(F.regexp_extract_all("seq", F.concat(F.lit(".{1,"), width.cast("string"), F.lit("}")), F.lit(0))).alias("k", "t"))
    made = F.concat(F.left("t", left.cast("int")), F.lit(LINKER), F.substr(F.col("t"), (left + 1).cast("int")), F.lit(ADAPTER))
    return cut.select(F.concat_ws("_", "seqid", "k").alias("seqid"), (doc * 1_000_000_000 + F.col("k")).alias("rec_idx"), F.when(plain, F.col("t")).otherwise(made).alias("seq"))
