"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, token windows scanned against it, hits verified.

Words: ASCII letters lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A window is ``width`` consecutive words of an item; an item of fewer words, but
not none, is one window. Every word of a text inside any occurrence of a window is hit.

The windows go to the workers in blocks of items of at most ``block_bytes`` of text, an item alone being a block at least: flat arrays of a hash, a place in the
block's words and an item number per window, behind a bit table. A block of the default size takes some 100 MB where every word is a letter, and a third of
that for prose. Blocks are built one at a time, so the driver holds one too. Every batch of texts is scanned against one block after another, each loaded
from the executor's disk and let go again where there are several: memory is that of one block whatever the benchmark's size, texts are read once, and
nothing is shuffled or written in between. A hash only proposes; the words themselves, compared with the block's, decide.

Null text: no words, no hits. Null items have no windows. Items that repeat a text all count, items that repeat an id count once. Repeated rows each give their
row. A very long text is a pass of its own. Columns of the table are carried under numbered names, so none can clash with results. Empty tables give no rows,
an empty benchmark no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytesops import Words, window_hashes
from .common import held, pieces

WIDTH = 10
BLOCK_BYTES = 8_000_000
_BITS = 22


class Block:
    """Windows of some items, for lookup by hash. ``by_len``: for each width, hashes in order, the first and the last byte of each window in ``data`` (lower-cased
    words, a space between two), and the group of equal windows that it belongs to; ``first`` and ``items`` say which items a group occurs in."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.ids = [i for i, _ in items]
        self.by_len: dict[int, tuple] = {}
        words = Words(pa.array([t for _, t in items], pa.string()))
        size = words.end - words.start
        stop = np.cumsum(size + 1)  # in data, one past the space
        start = stop - size - 1
        self.data = np.full(int(stop[-1]) if len(stop) else 0, 32, dtype=np.uint8)
        inside = np.repeat(words.start - start, size) + (np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size))
        self.data[inside - np.repeat(words.start - start, size)] = words.low[inside]
        hashes, n = words.hashes(), words.count
        for w in np.unique(np.minimum(n[n > 0], width)).tolist():
            own = np.flatnonzero(n >= w) if w == width else np.flatnonzero(n == w)
            at = np.concatenate([np.arange(words.first[k], words.first[k + 1] - w + 1) for k in own])
            item = np.repeat(own, n[own] - w + 1).astype(np.int32)
            h = _windows_at(hashes, at, w)
            order = np.lexsort((at, h))
            h, at, item = h[order], at[order], item[order]
            a, z = start[at], stop[at + w - 1] - 1
            group = self._groups(h, a, z)
            pairs = np.unique(group.astype(np.int64) * len(items) + item)
            first = np.searchsorted(pairs // len(items), np.arange(int(group.max()) + 2))
            one = np.concatenate([[True], group[1:] != group[:-1]])  # a window of each group; groups of one hash lie together
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.by_len[w] = (h[one], bits, a[one], z[one], group[one], first, (pairs % len(items)).astype(np.int32))

    def _groups(self, h: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Number of the class of equal windows of each entry; entries of one hash that differ are told apart by their words."""
        raw = self.data.tobytes()
        new = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(new) - 1
        differ = [i for i in np.flatnonzero(~new).tolist() if raw[a[i] : z[i]] != raw[a[i - 1] : z[i - 1]]]
        if not differ:
            return group
        numbers: dict = {}
        return np.array([numbers.setdefault((int(h[i]), raw[a[i] : z[i]]), len(numbers)) for i in range(len(h))])

    def scan(self, words: Words) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per word, whether it is hit; per text, the numbers of the items that occur."""
        hit = np.zeros(len(words.start) + 1, dtype=np.int32)
        none = np.zeros(0, np.int32)
        items: list[np.ndarray] = [none] * len(words.count)
        if not self.by_len or not len(words.start):
            return hit[:-1].astype(bool), items
        hashes = words.hashes()
        for w, (keys, bits, a, z, group, first, owners) in self.by_len.items():
            h = window_hashes(hashes, w)
            at = np.flatnonzero(bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            if not len(at):
                continue
            low = np.searchsorted(keys, h[at])
            near = keys[np.minimum(low, len(keys) - 1)] == h[at]
            doc = np.searchsorted(words.first, at, side="right") - 1
            inside = near & (at + w <= words.first[doc + 1])
            at, low, doc = at[inside], low[inside], doc[inside]
            found = np.full(len(at), -1, dtype=np.int64)
            for k, (i, s) in enumerate(zip(at.tolist(), low.tolist(), strict=True)):
                own = b" ".join([words.word(j) for j in range(i, i + w)])
                while s < len(keys) and keys[s] == h[i]:
                    if self.data[a[s] : z[s]].tobytes() == own:
                        found[k] = group[s]
                        break
                    s += 1
            at, doc, found = at[found >= 0], doc[found >= 0], found[found >= 0]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + w, -1)
            for d in np.unique(doc).tolist():
                own = [owners[first[g] : first[g + 1]] for g in np.unique(found[doc == d]).tolist()]
                items[d] = np.unique(np.concatenate([items[d], *own]))
        return np.cumsum(hit[:-1]) > 0, items


def _windows_at(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the windows that begin at ``at``."""
    return window_hashes(hashes, width)[at]


def blocks(benchmark: DataFrame, width: int, block_bytes: int, item_id: str, text: str) -> Iterator[Block]:
    """Items in order of partitions, cut into blocks of at most ``block_bytes`` of text; an item alone may be larger. Items stream through the driver."""
    some: list[tuple[str, str]] = []
    n = 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null")
    for r in rows.toLocalIterator():
        size = len(r["t"].encode())
        if some and n + size > block_bytes:
            yield Block(some, width)
            some, n = [], 0
        some.append((r["i"], r["t"]))
        n += size
    if some:
        yield Block(some, width)


_FOUND = "n_words long, hits array<int>, items array<string>"


def find_windows(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, list[str]]:
    """All columns of ``docs`` under the names ``_c0 ...`` and then ``n_words``, ``hits`` (word numbers), ``items`` (ids as strings); and the original names."""
    spark = docs.sparkSession
    names = list(docs.columns)
    order = [i for i, c in enumerate(names) if c != text] + [names.index(text)]
    inner = docs.toDF(*[f"_c{i}" for i in range(len(names))]).select(*[f"_c{i}" for i in order])
    sent = [spark.sparkContext.broadcast(b) for b in blocks(benchmark, width, block_bytes, item_id, item_text)]
    k = len(names) - 1

    def run(batches):
        for batch in batches:
            for part in pieces(batch, k):
                words = Words(part.column(k))
                mask = np.zeros(len(words.start), dtype=bool)
                items: list[list[str]] = [[] for _ in words.count]
                for b in held(sent):
                    own, found = b.scan(words)
                    mask |= own
                    for d, x in enumerate(found):
                        if len(x):
                            items[d] += [b.ids[j] for j in x.tolist()]
                hits = [np.flatnonzero(mask[words.first[d] : words.first[d + 1]]).tolist() if items[d] else [] for d in range(len(words.count))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(words.count, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    names=[*part.schema.names, "n_words", "hits", "items"],
                )

    out = T.StructType([*inner.schema.fields, *T.StructType.fromDDL(_FOUND).fields])
    return inner.mapInArrow(run, out), [names[i] for i in order]


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_hit_share: float = 0.0, text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows of which more than ``max_hit_share`` of the words are hit; columns as they were. 0.0: any occurrence removes the row."""
    found, names = find_windows(docs, benchmark, width, text=text, **how)
    keep = found.where(F.size("hits") <= F.lit(float(max_hit_share)) * F.greatest(F.col("n_words"), F.lit(1)))
    cols = found.columns[: len(names)]
    back = {n: c for n, c in zip(names, cols, strict=True)}
    return keep.select(*[F.col(back[n]).alias(n) for n in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text", **how) -> DataFrame:
    """``docs`` with the hit words cut out of the text (from the first byte of a run's first word to the end of its last), all rows kept."""
    found, names = find_windows(docs, benchmark, width, text=text, **how)

    def run(batches):
        for batch in batches:
            k = batch.num_columns - 4
            for part in pieces(batch, k):
                words = Words(part.column(k))
                texts = part.column(k).to_pylist()
                for d, hits in enumerate(part.column(k + 2).to_pylist()):
                    if not hits:
                        continue
                    a, at, kept = int(words.offsets[d]), 0, []
                    own = texts[d].encode()
                    i = 0
                    while i < len(hits):
                        j = i
                        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
                            j += 1
                        kept.append(own[at : int(words.start[words.first[d] + hits[i]]) - a])
                        at = int(words.end[words.first[d] + hits[j]]) - a
                        i = j + 1
                    texts[d] = b"".join([*kept, own[at:]]).decode()
                yield pa.RecordBatch.from_arrays([*part.columns[:k], pa.array(texts, pa.string())], names=part.schema.names[: k + 1])

    cut = found.mapInArrow(run, T.StructType(found.schema.fields[: len(names)]))
    back = dict(zip(names, cut.columns, strict=True))
    return cut.select(*[F.col(back[n]).alias(n) for n in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256 (ids sorted as strings, comma-joined), contaminated."""
    found, names = find_windows(docs.select(id_col, text), benchmark, width, text=text, **how)
    ids = F.array_sort(F.array_distinct("items"))
    return found.select(
        F.col(found.columns[names.index(id_col)]).alias(id_col),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
