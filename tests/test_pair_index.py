"""The layout by the Z-curve: its numbers, its rows, and how much of a file a rectangle reads."""

import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ligaspark.genome import Region
from ligaspark.sources import pair_index


def _z(a, b):
    return sum(((a >> k & 1) << (2 * k + 1)) | ((b >> k & 1) << (2 * k)) for k in range(31))


def test_z_values(spark):
    rng = random.Random(1)
    rows = [(0, 0), (1, 0), (0, 1), (2**31 - 1, 0), (0, 2**31 - 1), (2**31 - 1, 2**31 - 1), *[(rng.getrandbits(31), rng.getrandbits(31)) for _ in range(200)]]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", pair_index.z_value(F.col("a"), F.col("b")).alias("z")).collect()
    assert all(r["z"] == _z(r["a"], r["b"]) for r in got)
    assert spark.sql("SELECT CAST(NULL AS LONG) AS a, 1L AS b").select(pair_index.z_value(F.col("a"), F.col("b")).alias("z")).first()["z"] is None


def test_a_rectangle_reads_few_groups(spark, tmp_path):
    path = str(tmp_path / "index")
    n = 200_000
    pairs = spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("name"), F.lit("chr1").alias("chr1"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000_000)).alias("pos1"),
        F.lit("chr1").alias("chr2"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10_000_000)).alias("pos2"))
    pair_index.write_index(pairs, path, 64 << 10)
    one, two = Region("chr1", 1_000_000, 1_500_000), Region("chr1", 7_000_000, 7_400_000)
    held = [(r["name"], r["pos1"], r["pos2"]) for r in pairs.collect()]
    inside = lambda a, b, p, q: a.start <= p < a.end and b.start <= q < b.end
    want = sorted(x for x, p, q in held if inside(one, two, p, q) or inside(two, one, p, q))
    found = pair_index.read_index(spark, path, one, two)
    assert sorted(r["name"] for r in found.collect()) == want
    plan = found._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters: [") :].split("\n")[0]
    assert "Or(And(And(And(Greater" in pushed, pushed
    assert sorted(r["name"] for r in pair_index.read_index(spark, path, one).collect()) == sorted(x for x, p, q in held if inside(one, one, p, q))
    assert pair_index.read_index(spark, path, Region("chr9")).count() == 0 and pair_index.read_index(spark, path, Region("chr1")).count() == n
    groups = read = 0
    for file in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            s1, s2 = (meta.row_group(g).column(at[c]).statistics for c in ("pos1", "pos2"))
            groups += 1
            read += any(s1.max >= a.start and s1.min < a.end and s2.max >= b.start and s2.min < b.end for a, b in ((one, two), (two, one)))
    assert groups >= 30 and read <= groups / 5, (groups, read)


def test_one_place_and_nulls(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [("a", "chr1", 5, "chr1", 9)] * 50 + [("b", "chr1", None, "chr1", 3), ("c", None, 1, None, 2), ("d", "chr2", 5, "chr1", 9)]
    pair_index.write_index(spark.createDataFrame(rows, "name string, chr1 string, pos1 long, chr2 string, pos2 long"), path)
    assert spark.read.parquet(path).count() == 53
    assert pair_index.read_index(spark, path, Region("chr1", 0, 10)).count() == 50
    assert [r["name"] for r in pair_index.read_index(spark, path, Region("chr1", 0, 10), Region("chr2", 0, 10)).collect()] == ["d"]
