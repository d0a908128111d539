"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al. 2017).

The positives are texts confirmed as toxic; everything else, negatives included, is unlabelled. A linear scorer over the presence of words is trained on the risk

    prior * R+(positives as 1)  +  max(0, R-(unlabelled as 0) - prior * R-(positives as 0))

with logistic loss, where the class prior is a parameter or the share of toxic texts among the labelled rows of the training folds. When the second term is
negative, a step goes up its gradient instead, which keeps the scorer from memorising the positives.

Features: whether a word occurs, for at most ``features`` words that at least ``least`` positives have and that are commoner among positives than among all
texts by more than ``min_z`` standard errors. At most ``positives`` and ``unlabelled`` texts, spread by hash, choose the words and train the scorer; all bounds
are parameters. Words are counted by an aggregate over the sampled texts, and the driver gets the chosen words and which of them each text has, however long
the texts are. A text's score does not fade with its length: what counts is which of these words it has.

Null and empty texts have no words and get the score of the bias. No positives, or no such word: every score is 0. Conflicting labels of one id count as their
mean's nearest class, ties as 1; ties between words go to the smaller hash. Repeated rows each give their row; for fitting, rows that share an id count as one
text of all their words. A very long text is a pass of its own. Only the columns named are read, so no other can clash. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytesops import Words
from .common import bounded_sample, map_text, remainder, with_ids
from .quality import labelled

POSITIVES = 3_000
UNLABELLED = 9_000
FEATURES = 512
LEAST = 4
MIN_Z = 4.0


@dataclass
class Scorer:
    keys: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(texts)) if np.isneginf(self.bias) else np.full(len(texts), _sigmoid(self.bias))
        words = Words(texts)
        doc, at = self.present(words)
        return _sigmoid(self.bias + np.bincount(doc, weights=self.weights[at], minlength=len(texts)))

    def present(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of text and feature, each once."""
        h = words.hashes()
        bits = np.zeros(1 << 20, dtype=bool)
        bits[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        some = np.flatnonzero(bits[(h >> np.uint64(44)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        hit = self.keys[slot] == h[some]
        some, slot = some[hit], slot[hit]
        doc = np.searchsorted(words.first, some, side="right") - 1
        pairs = np.unique(doc * len(self.keys) + slot)
        return pairs // len(self.keys), pairs % len(self.keys)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def non_negative_pu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 200, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from presence matrices of positives and unlabelled rows, by full-batch Adam steps; deterministic."""
    k = xp.shape[1]
    w = np.zeros(k + 1)
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    xp, xu = np.hstack([xp, np.ones((len(xp), 1), np.float32)]), np.hstack([xu, np.ones((len(xu), 1), np.float32)])
    for t in range(1, steps + 1):
        now = w.astype(np.float32)
        sp, su = _sigmoid((xp @ now).astype(np.float64)), _sigmoid((xu @ now).astype(np.float64))
        up = prior * (xp.T @ (sp - 1).astype(np.float32)) / len(xp)  # positives as 1
        down = (xu.T @ su.astype(np.float32)) / len(xu) - prior * (xp.T @ sp.astype(np.float32)) / len(xp)  # negatives, estimated
        risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        g = (up + down if risk >= 0 else -down) + ridge * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def risk(xp: np.ndarray, xu: np.ndarray, prior: float, w: np.ndarray, b: float) -> float:
    """The non-negative risk of a scorer, as training sees it (without the ridge)."""
    loss = lambda x, y: np.log1p(np.exp(-np.clip((2 * y - 1) * (x @ w + b), -30, 30))).mean()
    return prior * loss(xp, 1) + max(0.0, loss(xu, 0) - prior * loss(xp, 0))


def _distinct_words():
    def f(texts):
        words = Words(texts)
        h = words.hashes().view(np.int64)
        own = [np.unique(h[a:b]) for a, b in zip(words.first, words.first[1:], strict=False)]
        ends = np.cumsum([0, *[len(x) for x in own]])
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*own, np.zeros(0, np.int64)])))]

    return f


def choose_words(words: DataFrame, n_p: int, n_u: int, features: int, least: int, min_z: float) -> np.ndarray:
    """Sorted hashes of the words whose rate among positives exceeds that among all texts the most, in standard errors. ``words``: (h, p, u), a row per text and
    word, with whether the text is among the positives and among the unlabelled."""
    counts = words.groupBy("h").agg(F.count_if("p").alias("p"), F.count_if("u").alias("u")).where(F.col("p") >= least)
    rest = (F.col("p") + F.col("u")) / F.lit(float(n_p + n_u))
    error = F.sqrt(F.greatest(rest * (1 - rest), F.lit(1e-9)) * F.lit(1 / n_p + 1 / n_u))
    z = (F.col("p") / F.lit(float(n_p)) - F.col("u") / F.lit(float(n_u))) / error
    found = counts.select("h", z.alias("z")).where(F.col("z") > min_z).orderBy(F.desc("z"), "h").limit(features).collect()
    return np.sort(np.array([r["h"] for r in found], dtype=np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", keep=lambda i: remainder(i, 5) != 0, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES, least: int = LEAST, min_z: float = MIN_Z, id_col: str = "doc_id", text: str = "text") -> Scorer:
    known = labelled(labels, column, keep, id_col)
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t")).first()
    none = Scorer(np.zeros(0, np.uint64), np.zeros(0), float("-inf"))
    if not counts["t"]:
        return none
    prior = min(0.9, counts["t"] / counts["n"]) if prior is None else prior
    ids_p = bounded_sample(known.where("y = 1"), positives, id_col, seed=3)
    ids_u = bounded_sample(docs.where(keep(F.col(id_col))).select(id_col), unlabelled, id_col, seed=33)
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    every = sorted({*ids_p, *ids_u})
    is_p, is_u = set(ids_p), set(ids_u)
    marks = spark.createDataFrame([(i, i in is_p, i in is_u) for i in every], T.StructType([T.StructField("_i", kind), T.StructField("p", T.BooleanType()), T.StructField("u", T.BooleanType())]))
    some = with_ids(docs.select(id_col, text), every, id_col)
    n = some.select(F.col(id_col).alias("_i")).distinct().join(F.broadcast(marks), "_i").agg(F.count_if("p").alias("p"), F.count_if("u").alias("u")).first()
    if not n["p"] or not n["u"]:
        return none
    words = map_text(some, _distinct_words, "h array<bigint>", text=text, carry=(id_col,)).select(F.col(id_col).alias("_i"), F.explode("h").alias("h")).distinct()
    keys = choose_words(words.join(F.broadcast(marks), "_i"), n["p"], n["u"], features, least, min_z)
    if not len(keys):
        return none
    sent = spark.sparkContext.broadcast(Scorer(keys, np.zeros(len(keys)), 0.0))

    def numbers():
        def f(texts):
            doc, at = sent.value.present(Words(texts))
            ends = np.searchsorted(doc, np.arange(len(texts) + 1))
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))]

        return f

    own = map_text(some, numbers, "k array<int>", text=text, carry=(id_col,))
    own = own.select(F.col(id_col).alias("_i"), F.explode_outer("k").alias("k")).groupBy("_i").agg(F.sort_array(F.collect_set("k")).alias("k"))  # features at most
    rows = sorted(own.collect(), key=lambda r: r["_i"])
    x = np.zeros((len(rows), len(keys)), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r["k"]] = 1
    weights, bias = non_negative_pu(x[[r["_i"] in is_p for r in rows]], x[[r["_i"] in is_u for r in rows]], prior)
    return Scorer(keys, weights, bias)


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score double), a row per row."""
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def make():
        s = sent.value
        return lambda texts: [pa.array(s.score(texts), pa.float64())]

    return map_text(docs, make, "score double", text=text, carry=(id_col,))
