"""Bounded labelled samples and small numpy fits shared by the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import small_batches


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int, where=None) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of
    each class 0 and 1, chosen by a hash of doc_id among all of them.

    Labels are grouped by doc_id first (a repeated label row counts once, a
    document labelled both ways goes by the larger label).  The sample of ids is
    bounded by the parameter, hence broadcast; of a repeated doc_id the text with
    the least hash is used, so texts are bounded too.
    """
    small_batches(docs.sparkSession)
    rows = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("label"))
    if where is not None:
        rows = rows.where(where)
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    parts = [rows.where(F.col("label") == c).orderBy("h", "doc_id").limit(per_class) for c in (0, 1)]
    chosen = parts[0].union(parts[1]).select("doc_id", "label")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    found = found.agg(F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text")).alias("t"))
    return found.select("doc_id", "t.text", "label")


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Rows of a sparse matrix: column indices and values with row pointers,
    twelve bytes an entry."""

    def __init__(self, indices, values, dim: int):
        self.ptr = np.concatenate([[0], np.cumsum([len(i) for i in indices])]).astype(np.int64)
        self.idx = np.concatenate([np.asarray(i, np.int32) for i in indices]) if len(indices) else np.zeros(0, np.int32)
        self.val = np.concatenate([np.asarray(v, np.float32) for v in values]) if len(values) else np.zeros(0, np.float32)
        self.dim, self.n = dim, len(self.ptr) - 1
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.ptr))

    def dot(self, w):
        return np.bincount(self.row, self.val * w[self.idx], self.n)

    def back(self, r):
        return np.bincount(self.idx, self.val * r[self.row], self.dim)

    def take(self, mask):
        out = object.__new__(Sparse)
        at = np.flatnonzero(mask)
        keep = mask[self.row]
        out.idx, out.val, out.dim, out.n = self.idx[keep], self.val[keep], self.dim, len(at)
        out.row = np.searchsorted(at, self.row[keep]).astype(np.int32)
        out.ptr = np.searchsorted(out.row, np.arange(out.n + 1))
        return out


def fit_logistic(x: Sparse, y: np.ndarray, l2: float = 1e-4, steps: int = 150, rate: float = 0.1):
    """Class-balanced logistic regression by Adam on the full sample: (w, b)."""
    y = np.asarray(y, float)
    share = np.where(y == 1, y.sum(), (1 - y).sum())
    weight = 0.5 / np.maximum(share, 1)
    w, b = np.zeros(x.dim), 0.0
    m, v, mb, vb = np.zeros(x.dim), np.zeros(x.dim), 0.0, 0.0
    for t in range(1, steps + 1):
        r = (sigmoid(x.dot(w) + b) - y) * weight
        g, gb = x.back(r) + l2 * w, r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b = b - rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, b


def platt(scores: np.ndarray, y: np.ndarray, steps: int = 100, count=None) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is a probability of y = 1, fitted
    by Newton steps on smoothed targets; a is never negative.  One class only:
    a constant probability.  ``count`` tells how often each score stands (once)."""
    y, s = np.asarray(y, float), np.asarray(scores, float)
    n = np.ones(len(y)) if count is None else np.asarray(count, float)
    pos, neg = (n * y).sum(), n.sum() - (n * y).sum()
    if not pos or not neg:
        share = (pos + 1) / (n.sum() + 2)
        return 0.0, float(np.log(share / (1 - share)))
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = (s.std() if count is None else np.sqrt(np.cov(s, fweights=count, ddof=0))) or 1.0
    s = s / scale
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * s + b)
        g = np.array([(n * (p - target) * s).sum(), (n * (p - target)).sum()])
        q = n * (p * (1 - p) + 1e-9)
        h = np.array([[(q * s * s).sum() + 1e-3, (q * s).sum()], [(q * s).sum(), q.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a / scale), 0.0), float(b)
