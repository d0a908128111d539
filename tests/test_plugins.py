"""Verbs and matrix formats that other packages add, and rectangles of ``.hic`` files against those of the store."""

import pytest

from ligaspark import cli, genome
from ligaspark.sources import matrices
from ligaspark.sources.hic_writer import write_hic
from ligaspark.sources.matrix_store import write_store


class Entry:
    def __init__(self, name, f):
        self.name, self.load = name, lambda: f


def test_verbs(monkeypatch):
    seen = []

    def more(spark, a):
        seen.append((spark, a.n))

    more.arguments = lambda parser: parser.add_argument("n", type=int)
    monkeypatch.setattr(cli, "entry_points", lambda group: [Entry("more", more), Entry("plain", lambda spark, a: seen.append("plain"))])
    assert cli.main(["more", "3"], spark="session") == 0 and cli.main(["plain"], spark="session") == 0
    assert seen == [("session", 3), "plain"]
    monkeypatch.setattr(cli, "entry_points", lambda group: [Entry("pipeline", more)])
    with pytest.raises(ValueError, match="pipeline"):
        cli.parser()


def test_backends(spark, tmp_path, monkeypatch):
    sizes = genome.chromosome_sizes(spark, [("chr1", 1000), ("chr2", 455)])
    px = spark.createDataFrame([(i, j, 1 + (i * 31 + j * 7) % 90) for i in range(146) for j in range(i, 146) if (i + j) % 3], "bin1_id long, bin2_id long, count long")
    write_store(px, sizes, 10, [10], str(tmp_path / "m.store"))
    write_hic(spark, {10: px}, sizes, str(tmp_path / "m.hic"))
    store, hic = (matrices.open_matrix(spark, str(tmp_path / n)) for n in ("m.store", "m.hic"))
    assert store.resolutions == hic.resolutions and store.lengths == hic.lengths
    R = genome.Region
    for one, two in ((R("chr1"), None), (R("chr1", 13, 97), R("chr1", 55, 301)), (R("chr2", 0, 100), R("chr1", 400, 410)), (R("chr1", 995, 1000), R("chr2")), (R("chr2", 450, 455), None)):
        rows = [sorted((r["i"], r["j"], float(r["count"])) for r in m.fetch(one, two, resolution=10).collect()) for m in (store, hic)]
        assert rows[0] == rows[1] and rows[0]
    with pytest.raises(ValueError, match="cool"):
        matrices.open_matrix(spark, "a.cool")
    monkeypatch.setitem(matrices.BACKENDS, "cool", lambda spark, path: path)
    assert matrices.open_matrix(spark, "a.cool") == "a.cool"
