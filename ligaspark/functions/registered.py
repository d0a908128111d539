"""SQL functions: ``register(spark)`` makes alignment, reverse complement, trimming, fragment search and site scans available to ``spark.sql``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..genome import parse_site
from ..operators import trim
from ..operators.fragments import nearest_rule
from .alignment import cost_table, locate_many
from .sequences import reverse_complement_text

_HIT = "ref_start int, ref_stop int, query_start int, query_stop int, matches int, cost int"


def register(spark: SparkSession) -> list[str]:
    """Registers ``align_locate(read, query)``, ``align_costs(read, query)`` (the table of costs), ``revcomp(seq)``, ``find_frag(positions, start, end, site length)``
    over a sorted array of sites, ``trim_read(seq, quality, linker, site, adapter)`` with the defaults of a trim, and the table function ``site_cuts(seq, site,
    cut)``; gives their names."""

    @F.pandas_udf(_HIT)
    def align_locate(read: pd.Series, query: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in _HIT.split(", ")]
        out = pd.DataFrame({n: pd.array([None] * len(read), dtype="Int32") for n in names}, index=read.index)
        for q, rows in read.fillna("").groupby(query.fillna("")):
            got = locate_many(rows.tolist(), q)
            for k, n in enumerate(names):
                out.loc[rows.index, n] = pd.array([int(v) if hit[1] >= 0 else None for v, hit in zip(got[:, k], got, strict=True)], dtype="Int32")
        return out

    @F.udf("array<array<int>>")
    def align_costs(read: str, query: str):
        return None if read is None or query is None else cost_table(read, query)

    @F.pandas_udf("idx long, side string, dis long")
    def find_frag(sites: pd.Series, start: pd.Series, end: pd.Series, site_len: pd.Series) -> pd.DataFrame:
        rows = []
        for p, s, e, n in zip(sites, start, end, site_len, strict=True):
            p = np.asarray([] if p is None else p, dtype=np.int64)
            if not len(p):
                rows.append((0, "s", 0))
                continue
            fs, fe = np.searchsorted(p, s + 1, side="right"), np.searchsorted(p, e - n - 1, side="right")
            hi = p[fe] if fe < len(p) else -1
            idx, side, dis, unknown = nearest_rule(*[np.array([v]) for v in (fs, fe, p[max(fs - 1, 0)], hi, s, e)])
            rows.append((int(idx[0]), str(side[0]), None if unknown[0] else int(dis[0])))
        return pd.DataFrame({"idx": [r[0] for r in rows], "side": [r[1] for r in rows], "dis": pd.array([r[2] for r in rows], dtype="Int64")}, index=start.index)

    @F.pandas_udf("flag int, pet1 string, pet2 string")
    def trim_read(seq: pd.Series, quality: pd.Series, linker: pd.Series, site: pd.Series, adapter: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"flag": 0, "pet1": None, "pet2": None}, index=seq.index)
        for (lk, st, ad), rows in seq.fillna("").groupby([linker.fillna(""), site.fillna(""), adapter.fillna("")]):
            flag, left, right, *_ = trim.trim_reads(rows.tolist(), quality.loc[rows.index].fillna("").tolist(), trim.TrimConfig((lk,), parse_site(st), adapter=ad))
            out.loc[rows.index, "flag"] = flag
            out.loc[rows.index, "pet1"] = left.field(0).to_pylist()
            out.loc[rows.index, "pet2"] = right.field(0).to_pylist()
        return out.astype({"flag": "int32"})

    @F.pandas_udf("string")
    def revcomp(seq: pd.Series) -> pd.Series:
        return seq.map(lambda s: None if s is None else reverse_complement_text(s))

    @F.udtf(returnType="pos: bigint")
    class SiteCuts:
        def eval(self, seq: str, site: str, cut: int) -> Iterator[tuple[int]]:
            for m in re.finditer(re.escape(site or ""), seq or "", re.I) if site else ():
                yield (m.start() + cut,)

    spark.udf.register("align_locate", align_locate)
    spark.udf.register("revcomp", revcomp)
    spark.udf.register("align_costs", align_costs)
    spark.udf.register("find_frag", find_frag)
    spark.udf.register("trim_read", trim_read)
    spark.udtf.register("site_cuts", SiteCuts)
    return ["align_costs", "align_locate", "find_frag", "revcomp", "site_cuts", "trim_read"]
