"""Helpers that all text operators share: Arrow mapping, tables in the shared folder, folds and bounded samples."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, written as materialize  # noqa: F401 - tables in the shared folder, for all operators

#: Bytes of text that one NumPy pass works on; bounds a worker's memory whatever the batch size (a longer text is a pass of its own).
PASS_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- Arrow mapping


def pieces(batch: pa.RecordBatch, column: int, most: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose text column holds at most ``most`` bytes, or a single row."""
    n = batch.num_rows
    if not n:
        return
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def map_text(df: DataFrame, make: Callable[[], Callable], fields: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns of ``df`` plus the columns ``fields`` that the function from ``make()`` computes from slices of the text column.

    ``make`` runs once per task in the worker and returns ``f(pa.Array of strings) -> list of arrays``. Only the carried columns and the text leave
    the JVM, so other columns of ``df`` cannot clash with the results.
    """
    extra = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    inner = df.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)], F.col(f"`{text}`").cast("string").alias("_text"))
    out = T.StructType([T.StructField(f"_c{i}", inner.schema[i].dataType) for i in range(len(carry))] + [T.StructField(f.name, f.dataType) for f in extra])
    k, names = len(carry), [f"_c{i}" for i in range(len(carry))] + extra.names

    def run(batches):
        f = make()
        for batch in batches:
            for part in pieces(batch, k):
                made = f(part.column(k))
                yield pa.RecordBatch.from_arrays([*part.columns[:k], *made], names=names)
            del batch
            pa.default_memory_pool().release_unused()  # workers are reused, and share an executor's memory with the JVM

    got = inner.mapInArrow(run, out)
    return got.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], *extra.names)


def filter_text(df: DataFrame, make: Callable[[], Callable], text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, for which the function from ``make()`` gives True: ``f(pa.Array) -> bool array``."""
    k = df.columns.index(text)
    names = [f"_c{i}" for i in range(len(df.columns))]
    inner = df.toDF(*names)

    def run(batches):
        f = make()
        for batch in batches:
            for part in pieces(batch, k):
                yield part.filter(pa.array(f(part.column(k)), type=pa.bool_()))
            del batch
            pa.default_memory_pool().release_unused()

    return inner.mapInArrow(run, inner.schema).toDF(*df.columns)


def held(sent: list) -> Iterator:
    """Values of broadcast variables, one after another; where there are several, each is let go before the next one is loaded from the executor's disk."""
    for b in sent:
        yield b.value
        if len(sent) > 1:
            b.__dict__.pop("_value", None)


# ---------------------------------------------------------------- folds and bounded samples


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % F.lit(m)


def bounded_sample(df: DataFrame, per_group: int, id_col: str = "doc_id", group: str | None = None, seed: int = 7, last: str | None = None) -> list:
    """Ids of at most ``per_group`` rows per value of ``group``, spread evenly by hash.

    Each hash bucket of a group gives the id of its smallest hash, which is an ordinary aggregate combined before the shuffle: no window, no skew, and
    the driver gets ``per_group`` ids per group whatever the input's size. Rows for which the column ``last`` holds come after the others of their bucket. Rows
    with a null id or group take no part. Reruns agree.
    """
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    keys = [F.pmod(h, F.lit(per_group)).alias("_b")] + ([F.col(group).alias("_g")] if group else [])
    rows = df.where(F.col(id_col).isNotNull() & (F.col(group).isNotNull() if group else F.lit(True)))
    order = F.struct((F.col(last) if last else F.lit(False)).alias("l"), F.xxhash64(F.col(id_col), F.lit(seed + 1)).alias("h"), F.col(id_col).alias("i"))
    rows = rows.groupBy(*keys).agg(F.min(order).alias("_m"))
    got = rows.select(*(["_g"] if group else []), F.col("_m.i").alias("_i")).collect()
    return sorted({(r["_g"], r["_i"]) for r in got}) if group else sorted({r["_i"] for r in got})


def with_ids(df: DataFrame, ids: list, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in the bounded list ``ids``."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    few = spark.createDataFrame([(i,) for i in ids], T.StructType([T.StructField(id_col, kind)]))
    return df.join(F.broadcast(few), id_col, "left_semi")


def tokenizer_dir() -> str:
    """Where the public tokenizer files are unless a caller names another folder."""
    return os.environ.get("LIGASPARK_TOKENIZERS", "/opt/tokenizers")
