"""Exact top-k by inner product with pivot-table elimination.

Vectors become integers (floor of 256 times each component). For a pivot p, | d(q,p) - d(x,p) | bounds the distance of q and x from below; the most of these over
all pivots is the bound, and  q.x = (|q|^2 + |x|^2 - d(q,x)^2) / 2  turns it into a bound of the score from above. A query's candidates are evaluated in order of
that bound until it falls below the k-th best score so far, which is exact; candidates whose bound equals that score are still evaluated, for ties go to the
smaller id.

The pivot table is computed once and written: each row's squared length, its distances to ``pivots`` pivots (of a bounded sample, by farthest-first traversal), and
its block. A block is a cell of the rows nearest to one pivot, split by hash into parts of about ``block`` rows, so copies of one vector are never one group. From
the table come the blocks' ranges of distances, which bound a query's best score in a whole block.

The search has two steps. First each query meets the one block that promises most, and its k-th best score there is its threshold. Then it meets exactly the
other blocks whose bound reaches the threshold. Rows are shuffled once in each step, whatever the number of queries; queries go only where they can find
something. A task holds one block and streams queries past it, so its memory is bounded by ``block`` (queries of one block are salted by the million). The
work grows with queries times rows at worst, as an exact search over a stated query set must; memory and the shuffle of rows do not.

Vectors that are null, or hold a null or a component that is not finite, take no part, nor do rows with a null id; vectors are compared with those of their own
length. Quantised components are clamped to 32 bits (components beyond 8 388 607); scores are exact integers, and clamped to 64 bits. Rows that repeat an id
are candidates each, and queries each only once (the id's first vector in order). A query with fewer than k candidates gets all. Only the two columns named are
read, so no other can clash. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, discard, held, materialize, with_ids

K = 5
PIVOTS = 32
PIVOT_SAMPLE = 512
BLOCK = 16_384
QUERIES_PER_SALT = 1_000_000
_STATS = 65_536  # blocks whose ranges a worker holds at once
_ROUND = 64  # candidates evaluated at first; twice as many each time
_CLAMP = (1 << 31) - 1
_EXACT, _EXACT_SINGLE = 2.0**53, 2.0**24
_QUERIES = 16  # whose bounds are computed together


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v array<int>, dim) of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    ok = F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c, F.lit(-1e9)), F.lit(1e9)) * 256), F.lit(-_CLAMP)), F.lit(_CLAMP)).cast("int")
    return vectors.where(ok).select(F.col(f"`{id_col}`").alias("id"), F.transform(x, whole).alias("v"), F.size(x).alias("dim"))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the vector farthest from those chosen."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample.astype(float) ** 2).sum(axis=1)))]
    far = ((sample - sample[chosen[0]]).astype(float) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]).astype(float) ** 2).sum(axis=1))
    return sample[chosen]


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T), 0.0))


def _slack(n2):
    """Room for rounding in a bound of scores, which are integers."""
    return 1e-3 + 1e-9 * n2


def _upper(far: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Bound of the score from above, from one of the distance from below and the sum of both squared lengths."""
    return (n2 - np.maximum(far - 1e-6 - 1e-9 * np.sqrt(n2), 0) ** 2) / 2 + _slack(n2)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of one integer vector with the rows of a matrix; in floats where they are exact, else in Python's integers."""
    if not x.size or np.abs(q).max() * np.abs(x).max() * x.shape[1] < _EXACT:
        return x @ q
    top = (1 << 63) - 1
    return np.array([max(-top, min(top, sum(int(a) * int(b) for a, b in zip(q, r, strict=True)))) for r in x], dtype=object)


class Candidates:
    """Rows of a block with their part of the pivot table, in order of ids, so that equal scores are met in that order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, n2: np.ndarray, far: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.n2, self.far = ids[order], x[order], n2[order], far[order]
        self.top, self.single, self.work = np.abs(self.x).max(initial=0), None, 0

    def best(self, owns: list, q: np.ndarray, n2: np.ndarray, far: np.ndarray, k: int, least: list) -> list[tuple[np.ndarray, list]]:
        """For each query the rows and scores of its k best candidates that reach its ``least`` (None: any), but those of its own id; best first, ties by id.

        Bounds of some queries at a time come from the table. A query that the bounds leave few candidates evaluates them in their order. One that they leave many
        evaluates the most promising first, and then, at once, all whose bound reaches the k-th best of those."""
        out = []
        for a in range(0, len(owns), _QUERIES):
            rows = slice(a, a + _QUERIES)
            bound = np.zeros((len(owns[rows]), len(self.ids)))
            for j in range(self.far.shape[1]):
                np.maximum(bound, np.abs(far[rows, j][:, None] - self.far[None, :, j]), out=bound)
            upper = _upper(bound, n2[rows][:, None] + self.n2[None, :])
            for i, own in enumerate(owns[rows]):
                low = least[a + i]
                live = np.arange(len(self.ids)) if low is None else np.flatnonzero(upper[i] >= low)
                live = live[self.ids[live] != own]
                if len(live) > max(4 * _ROUND, len(self.ids) // 8):
                    first = live[np.argpartition(-upper[i, live], _ROUND)[:_ROUND]]
                    found = self._ordered(first, upper[i, first], q[a + i], k, low)
                    low = found[1][-1] if len(found[1]) == k else low
                    out.append(self._at_once(live if low is None else live[upper[i, live] >= low], q[a + i], k))
                else:
                    out.append(self._ordered(live, upper[i, live], q[a + i], k, low))
        return out

    def _ordered(self, live: np.ndarray, upper: np.ndarray, q: np.ndarray, k: int, kth) -> tuple[np.ndarray, list]:
        rank = np.argsort(-upper, kind="stable")
        live, upper = live[rank], upper[rank]
        rows, found, at, step = np.zeros(0, np.int64), [], 0, _ROUND
        while at < len(live) and (kth is None or upper[at] >= kth):
            part = live[at : at + step]
            at, step = at + step, step * 2
            self.work += len(part)
            got = scores(q, self.x[part])
            if kth is not None:
                part, got = part[got >= kth], got[got >= kth]
            rows, found = np.concatenate([rows, part]), [*found, *got.tolist()]
            keep = sorted(range(len(rows)), key=lambda i: (-found[i], rows[i]))[:k]
            rows, found = rows[keep], [found[i] for i in keep]
            if len(found) == k:
                kth = found[-1] if kth is None else max(kth, found[-1])
        return rows, found

    def _at_once(self, live: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, list]:
        self.work += len(live)
        got = self._all(q)[live]
        if len(live) > k:
            near = got >= np.partition(got, len(got) - k)[len(got) - k]
            live, got = live[near], got[near]
        keep = sorted(range(len(live)), key=lambda i: (-got[i], live[i]))[:k]  # the k best and what ties with the last
        return live[keep], got[keep].tolist()

    def _all(self, q: np.ndarray) -> np.ndarray:
        """Scores of all rows, which are read in place; in single precision where that is exact too."""
        top = np.abs(q).max(initial=0) * self.top * self.x.shape[1]
        if top < _EXACT_SINGLE:
            if self.single is None:
                self.single = self.x.astype(np.float32)
            return (self.single @ q.astype(np.float32)).astype(np.float64)
        return scores(q, self.x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def pivot_table(rows: DataFrame, pivots: int, sample: int, seed: int = 6) -> DataFrame:
    """(id, v, dim, n2, far array<double>, cell): the rows with their distances to the pivots of their length, and the number of the nearest one. A length that the
    sample lacks has one cell and no pivots."""
    ids = bounded_sample(rows.select("id"), sample, "id", seed=seed)
    by_dim: dict[int, list] = {}
    few = with_ids(rows, ids, "id").groupBy("id", "dim").agg(F.min("v").alias("v")) if ids else rows.limit(0)
    for r in sorted(few.select("id", "dim", "v").collect(), key=lambda r: (r["dim"], r["id"], r["v"])):
        by_dim.setdefault(r["dim"], []).append(r["v"])
    chosen = {d: choose_pivots(np.array(v, dtype=np.float64).reshape(len(v), d), pivots) for d, v in by_dim.items() if d}
    sent = rows.sparkSession.sparkContext.broadcast(chosen)
    kind = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("n2 double, far array<double>, cell int").fields])

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            n2, cell, far = np.zeros(len(dims)), np.zeros(len(dims), np.int32), [[]] * len(dims)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = _matrix(batch.column(1).take(pa.array(at)), d)
                n2[at] = (x * x).sum(axis=1)
                if d in sent.value:
                    p = to_pivots(x, sent.value[d])
                    cell[at] = p.argmin(axis=1)
                    for i, own in zip(at.tolist(), p, strict=True):
                        far[i] = own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n2), pa.array(far, pa.list_(pa.float64())), pa.array(cell)], names=kind.names)

    return rows.mapInArrow(run, kind)


def with_blocks(table: DataFrame, block: int) -> DataFrame:
    """The pivot table with ``part``: cells of more than ``block`` rows are split by a hash of id and place, so one vector's copies spread too."""
    sizes = table.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))  # a row per pivot
    salt = F.xxhash64("id", F.monotonically_increasing_id() % 1024)
    return table.join(F.broadcast(sizes), ["dim", "cell"]).withColumn("part", F.pmod(salt, "parts").cast("int")).drop("parts")


class Ranges:
    """Ranges of pivot distances and the largest squared length of some blocks of one length of vectors."""

    def __init__(self, rows: list, width: int):
        self.dim, self.cells, self.parts = rows[0]["dim"], np.array([r["cell"] for r in rows], np.int32), np.array([r["part"] for r in rows], np.int32)
        self.low, self.high = (np.array([r[c] for r in rows], dtype=np.float64).reshape(len(rows), width) for c in ("low", "high"))
        self.n2 = np.array([r["n2"] for r in rows])

    def upper(self, far: np.ndarray, n2: float) -> np.ndarray:
        """Best score that a query can reach in each block."""
        gap = np.maximum(np.maximum(self.low - far, far - self.high), 0)
        return _upper(gap.max(axis=1) if gap.shape[1] else np.zeros(len(gap)), n2 + self.n2)


def block_ranges(table: DataFrame) -> list[Ranges]:
    """Of all blocks, in lists of at most ``_STATS``; they come to the driver, a row for each ``block`` rows of the table."""
    width = F.size("far")
    spread = table.select("dim", "cell", "part", "n2", width.alias("w"), F.posexplode_outer("far").alias("j", "d"))
    by = spread.groupBy("dim", "cell", "part", "w", "j").agg(F.min("d").alias("a"), F.max("d").alias("z"), F.max("n2").alias("n2"))
    pairs = F.array_sort(F.collect_list(F.when(F.col("j").isNotNull(), F.struct("j", "a", "z"))))
    rows = by.groupBy("dim", "cell", "part", "w").agg(F.max("n2").alias("n2"), pairs.alias("p"))
    rows = rows.select("dim", "cell", "part", "w", "n2", F.transform("p", lambda x: x["a"]).alias("low"), F.transform("p", lambda x: x["z"]).alias("high")).orderBy("dim", "cell", "part")
    out, some = [], []
    for r in rows.toLocalIterator():
        if some and (some[0]["dim"] != r["dim"] or len(some) == _STATS):
            out.append(Ranges(some, some[0]["w"] if some[0]["w"] > 0 else 0))
            some = []
        some.append(r)
    if some:
        out.append(Ranges(some, some[0]["w"] if some[0]["w"] > 0 else 0))
    return out


_FOR_BLOCKS = "least long, cell int, part int"


def _routed(queries: DataFrame, sent: list, first: bool) -> DataFrame:
    """Each query with the blocks that it has to meet: the one that promises most at ``first``, later all others that reach its threshold ``least``."""
    base = queries.schema
    out = T.StructType([*base.fields[:5], *T.StructType.fromDDL(_FOR_BLOCKS).fields])

    def run(batches):
        for batch in batches:
            dims, n2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            far = batch.column(4).to_pylist()
            least = batch.column(5).to_pylist()
            old = [batch.column(6).to_pylist(), batch.column(7).to_pylist()] if not first else None
            best = [(-np.inf, 0, 0)] * len(dims)
            for r in held(sent):
                at, cells, parts = [], [], []
                for i in np.flatnonzero(dims == r.dim).tolist():
                    upper = r.upper(np.array(far[i]), n2[i])
                    if first:
                        j = int(upper.argmax())
                        if upper[j] > best[i][0]:
                            best[i] = (upper[j], int(r.cells[j]), int(r.parts[j]))
                        continue
                    ok = (upper >= (-np.inf if least[i] is None else least[i])) & ~((r.cells == old[0][i]) & (r.parts == old[1][i]))
                    at.append(np.full(int(ok.sum()), i)), cells.append(r.cells[ok]), parts.append(r.parts[ok])
                if at and not first:
                    yield from _rows(batch, np.concatenate(at), least, np.concatenate(cells), np.concatenate(parts), out)
            if first:
                yield from _rows(batch, np.arange(len(dims)), least, np.array([b[1] for b in best], np.int32), np.array([b[2] for b in best], np.int32), out)

    return queries.mapInArrow(run, out)


def _rows(batch: pa.RecordBatch, at: np.ndarray, least: list, cells: np.ndarray, parts: np.ndarray, out: T.StructType):
    for a in range(0, len(at), 8_192):  # a query may meet many blocks
        some = at[a : a + 8_192]
        take = [c.take(pa.array(some)) for c in batch.columns[:5]]
        yield pa.RecordBatch.from_arrays([*take, pa.array([least[i] for i in some.tolist()], pa.int64()), pa.array(cells[a : a + 8_192], pa.int32()), pa.array(parts[a : a + 8_192], pa.int32())], names=out.names)


def _met(table: DataFrame, routed: DataFrame, k: int, salts: int) -> DataFrame:
    """(query_id, id, score, cell, part): the k best of each query in each block that it was sent to. Rows of a block come before its queries, which stream past."""
    many = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))) if salts > 1 else F.lit(0)
    rows = table.select("id", "v", "dim", "n2", "far", F.lit(None).cast("long").alias("least"), "cell", "part", F.lit(0).alias("kind"), many.alias("salt"))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    queries = routed.select("id", "v", "dim", "n2", "far", "least", "cell", "part", F.lit(1).alias("kind"), salt.alias("salt"))
    key = ["dim", "cell", "part", "salt"]
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.unionByName(queries).repartition(parts, *key).sortWithinPartitions(*key, "kind")
    kind = T.StructType([T.StructField("query_id", table.schema["id"].dataType), T.StructField("id", table.schema["id"].dataType), *T.StructType.fromDDL("score long, cell int, part int").fields])

    def run(batches):
        block, gathered, now = None, [], None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 6, 7, 9, 8)]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if a == z:
                    continue
                part = batch.slice(a, z - a)
                place = tuple(int(c[a]) for c in cols)
                if place[:4] != now:
                    now, gathered, block = place[:4], [], None
                dim = place[0]
                x, far = _matrix(part.column(1), dim), part.column(4)
                width = len(far[0].as_py()) if len(far) else 0
                far = _matrix(far, width)
                if place[4] == 0:
                    gathered.append((part.column(0).to_numpy(zero_copy_only=False), x, part.column(3).to_numpy(), far))
                    continue
                if block is None and gathered:
                    block = Candidates(*[np.concatenate(c) for c in zip(*gathered, strict=True)])
                    gathered = []
                if block is None:
                    continue
                out_q, out_x, out_s = [], [], []
                owns = part.column(0).to_pylist()
                for own, (rows_, got) in zip(owns, block.best(owns, x, part.column(3).to_numpy(), far, k, part.column(5).to_pylist()), strict=True):
                    out_q += [own] * len(got)
                    out_x += block.ids[rows_].tolist()
                    out_s += [int(v) for v in got]
                n = len(out_q)
                own_kind = part.schema.field(0).type
                yield pa.RecordBatch.from_arrays([pa.array(out_q, own_kind), pa.array(out_x, own_kind), pa.array(out_s, pa.int64()), pa.array(np.full(n, place[1], np.int32)), pa.array(np.full(n, place[2], np.int32))], names=kind.names)

    return both.mapInArrow(run, kind)


def top_k(vectors: DataFrame, is_query, k: int = K, pivots: int = PIVOTS, block: int = BLOCK, queries_per_salt: int = QUERIES_PER_SALT, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row for which ``is_query(id column)`` holds, its k best among all rows but those of its own id."""
    rows = materialize(quantised(vectors, id_col, vector))
    far = materialize(pivot_table(rows, pivots, PIVOT_SAMPLE))
    table = materialize(with_blocks(far, block))
    discard(rows, far)
    picked = table.where(is_query(F.col("id"))).groupBy("id").agg(F.min(F.struct("dim", "v", "n2", "far")).alias("q"))
    queries = materialize(picked.select("id", "q.v", "q.dim", "q.n2", "q.far"))
    salts = -(-max(1, queries.count()) // queries_per_salt)
    sent = [table.sparkSession.sparkContext.broadcast(r) for r in block_ranges(table)]
    start = materialize(_routed(queries.withColumn("least", F.lit(None).cast("long")), sent, True))
    near = materialize(_met(table, start, k, salts))
    ranked = best(near, k)
    least = ranked.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("_l"))
    known = start.drop("least").join(least, "id", "left").select("id", "v", "dim", "n2", "far", F.col("_l").alias("least"), "cell", "part")
    found = near.unionByName(_met(table, _routed(known, sent, False), k, salts))
    out = materialize(best(found, k))
    discard(table, queries, start, near)
    return out


def best(part: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score): the k best of each query, ties to the smaller id; a query has at most k rows per block here."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
