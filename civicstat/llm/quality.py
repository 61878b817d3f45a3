"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text gives a vector of statistics, transformed so that heavy tails and
shares near 0 or 1 become roughly normal. Each class has its mean and a
covariance shrunk towards the diagonal of the pooled covariance. The score
is the logistic function of the difference of the two log densities plus the
log odds of the labels; the densities come from Mahalanobis distances with
Cholesky factors that are made once and shipped with the model.

Fitting takes sums over all labelled rows: counts, sums and sums of products
are added up in the tasks, and the driver gets two rows of fixed size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.llm.common import cut, one_label, prepare, remainder
from civicstat.llm.rules import Measures

NAMES = ("words", "word_chars", "word_spread", "symbols", "upper", "shouts", "digits", "distinct",
         "dup_lines", "repeats", "top_word", "stops", "commas", "no_letter", "short_words", "line_chars", "entropy")
#: Share of the pooled diagonal in a class's covariance.
SHRINK = 0.1
#: No variance is below this, so a statistic that never varies does no harm.
FLOOR = 1e-3
THRESHOLD = 0.3


_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def _root(share: float) -> float:
    return math.sqrt(max(share, 0.0))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; of an empty one all but zero."""
    m = Measures(text)
    words, n, t = m.words, m.n_words, m.text
    if not n:
        return [0.0] * len(NAMES)
    sizes = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    c = np.fromiter(counts.values(), np.float64, len(counts)) / n
    upper = len(_UPPER.findall(t))
    lines = len(m.lines)
    digits = sum(map(t.count, "0123456789"))
    bare = sum(1 for w in counts if not (w.isalpha() or w[:1].isalpha() or w[0] > 127))
    return [
        math.log1p(n), math.log(m.word_chars / n), math.log1p(float(sizes.std())),
        _root(m.n_symbols / n), _root(upper / len(t)), _root(t.count("!") / n), _root(digits / n),
        _root(1 - len(counts) / n), _root(m.n_dup_lines / max(lines, 1)), _root(m.n_repeat_words / n),
        _root(float(c.max())), _root(t.count(".") / n), _root(t.count(",") / n),
        _root(bare / len(counts)), _root(float((sizes <= 3).mean())), math.log1p(m.word_chars / max(lines, 1)),
        float(-(c * np.log(c)).sum()) / math.log(n + 1)]


@dataclass
class Model:
    """Means, Cholesky factors and half log determinants of both classes, log odds of class 1."""

    means: np.ndarray
    factors: np.ndarray
    halves: np.ndarray
    odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of class 1 of the rows of ``x``."""
        logs = []
        for mean, factor, half in zip(self.means, self.factors, self.halves):
            z = np.linalg.solve(factor, (x - mean).T)  # a triangular system
            logs.append(-0.5 * (z * z).sum(axis=0) - half)
        d = np.clip(logs[1] - logs[0] + self.odds, -500, 500)
        return 1 / (1 + np.exp(-d))


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x: array of statistics) of ``docs`` (doc_id, text), row by row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def fit(stats: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> Model | None:
    """The model of all rows of ``stats`` whose id ``labels`` (id, label 0 or 1)
    names; None unless both labels occur."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for b in batches:
            y = b.column(1).to_numpy()
            x = b.column(0).flatten().to_numpy().reshape(-1, d)
            for k in (0, 1):
                own = x[y == k]
                n[k] += len(own)
                s[k] += own.sum(axis=0)
                ss[k] += own.T @ own
        every = np.concatenate([n[:, None], s, ss.reshape(2, -1)], axis=1)
        yield pa.RecordBatch.from_pydict(
            {"label": np.repeat([0, 1], every.shape[1]), "i": np.tile(np.arange(every.shape[1]), 2),
             "v": every.ravel()}, pa.schema([("label", pa.int32()), ("i", pa.int32()), ("v", pa.float64())]))

    rows = stats.join(labels, stats["doc_id"] == labels["id"]).select("x", "label")
    sums = rows.mapInArrow(run, "label int, i int, v double").groupBy("label", "i").agg(F.sum("v").alias("v"))
    found = np.zeros((2, 1 + d + d * d))
    for r in sums.collect():
        found[r["label"], r["i"]] = r["v"]
    n = found[:, 0]
    if not n.all():
        return None
    means = found[:, 1:1 + d] / n[:, None]
    covs = found[:, 1 + d:].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covs * n[:, None, None]).sum(axis=0) / n.sum()
    target = np.diag(np.maximum(np.diag(pooled), FLOOR))
    covs = (1 - shrink) * covs + shrink * target
    covs += FLOOR * np.eye(d)
    factors = np.linalg.cholesky(covs)
    halves = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    return Model(means, factors, halves, math.log(n[1] / n[0]))


def classify(docs: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text); ``labels`` has (id, label).

    Null and empty texts have the statistics of no words and get a score like
    any other; very long texts are measured whole. Repeated rows get equal
    scores, and equal scores of different texts stand as they are; ids with
    contradicting labels are to be left out of ``labels``. Other columns are
    ignored. If one label is missing all scores are that of the other (1.0 without any
    label). An empty table gives no row.
    """
    stats = cut(with_statistics(docs))
    model = fit(stats, labels, shrink)
    if model is None:
        only = labels.agg(F.min("label")).head()[0]
        return stats.select("doc_id", F.lit(1.0 if only is None else float(only)).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return stats.mapInArrow(run, T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    known = one_label(labels, "quality").where(remainder(F.col("id"), 5) != 0)
    found = classify(documents, known)
    return found.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
