"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

The trees are trained on the driver from at most ``sample`` labelled rows (spread by hash; the bound is a parameter), whose statistics the workers compute, and
sent to the workers as a few flat arrays. Every whole text is scored. Null and empty texts are scored by their (zero) statistics. No labelled rows: every score
is 0.5. Conflicting labels of one id count as their mean's nearest class, ties as 1; ties between splits go to the feature that is listed first and the lower
threshold. Repeated rows each give their row; for training, rows that share an id count once, by the smallest statistics. A very long text is a pass of its own. Only
the columns named are read, so no other can clash. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Forest, train
from .common import bounded_sample, map_text, remainder, with_ids
from .features import NAMES, table

SAMPLE = 12_000


def labelled(labels: DataFrame, column: str, keep, id_col: str = "doc_id") -> DataFrame:
    """(id, y): one label for each id of the training folds."""
    rows = labels.where(F.col(column).isNotNull() & keep(F.col(id_col)))
    return rows.groupBy(id_col).agg((F.avg(column) >= 0.5).cast("int").alias("y"))


def _statistics():
    def f(texts):
        made = table(texts)
        return [pa.FixedSizeListArray.from_arrays(pa.array(made.ravel(), pa.float32()), len(NAMES)).cast(pa.list_(pa.float32()))]

    return f


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", keep=lambda i: remainder(i, 4) != 2, sample: int = SAMPLE, id_col: str = "doc_id", text: str = "text", **how) -> Forest:
    known = labelled(labels, column, keep, id_col)
    ids = bounded_sample(known, sample, id_col, seed=4)
    y = {r[id_col]: r["y"] for r in with_ids(known, ids, id_col).collect()}
    if ids:
        made = map_text(with_ids(docs.select(id_col, text), ids, id_col), _statistics, "x array<float>", text=text, carry=(id_col,))
        rows = sorted((r[id_col], tuple(r["x"])) for r in made.groupBy(id_col).agg(F.min("x").alias("x")).collect())
    else:
        rows = []
    x = np.array([r[1] for r in rows], dtype=np.float32).reshape(len(rows), len(NAMES))
    return train(x, np.array([y[r[0]] for r in rows], dtype=np.float64), **how)


def score(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score double), a row per row."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def make():
        trees = sent.value
        return lambda texts: [pa.array(trees.score(table(texts)), pa.float64())]

    return map_text(docs, make, "score double", text=text, carry=(id_col,))
