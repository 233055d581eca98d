"""Toxicity severity by cumulative-link ordinal regression.

Grades 0 < 1 < ... < G share one weight vector over sparse text features; thresholds t_1 < ... < t_G
cut its score: P(grade >= j) = sigmoid(w.x - t_j). The expected severity is the sum of these.

The model is fitted on a bounded sample of labelled documents (``rows``) and scores every document.
``labels`` has toxic 0 or 1 only; severity among the toxic is taken from the sample itself: words
that are ``RATIO`` times as frequent (by documents) in toxic as in other documents are markers, and a toxic
document with more marker occurrences than the median toxic one has grade 2, else 1.

Defined cases: a NULL or empty text has the features of no words; repeated rows and NULL doc_ids are scored row
by row; without labels of both kinds every document gets severity 0 and is not toxic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import features as X
from pitpanel.llm import shingles as S
from pitpanel.llm.base import texts

ROWS = 12_000
LEAST_DOCS, CHI2 = 5, 20.0     # features in fewer sampled documents, or unrelated to the label, get no weight
RATIO = 8.0
STEPS, RATE, RIDGE = 200, 0.3, 1e-4
GRADES = 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def grades(feature: np.ndarray, count: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for documents that are not toxic, else 1 or 2; see the module."""
    n = len(toxic)
    in_toxic = np.bincount(feature, weights=toxic[owner], minlength=X.DIM)
    in_other = np.bincount(feature, minlength=X.DIM) - in_toxic
    marker = (in_toxic >= LEAST_DOCS) & \
        (in_toxic / max(toxic.sum(), 1) > RATIO * (in_other + 0.5) / max((1 - toxic).sum(), 1))
    hits = np.bincount(owner, weights=count * marker[feature], minlength=n)
    middle = np.median(hits[toxic == 1]) if toxic.any() else 0
    return toxic * (1 + (hits > middle))


def fit(feature: np.ndarray, owner: np.ndarray, grade: np.ndarray, top: int = GRADES) -> tuple:
    """(weights, thresholds) that maximise the ridge-penalised ordinal likelihood."""
    n = len(grade)
    weight = X.telling(feature, owner, np.minimum(grade, 1), 2, LEAST_DOCS, CHI2)
    kept, feature, owner = X.compact(weight, feature, owner)
    dim = len(kept)
    share = [np.clip((grade >= j).mean(), 1e-4, 1 - 1e-4) for j in range(1, top + 1)]
    first = -np.log(share[0] / (1 - share[0]))
    gaps = np.log(np.maximum(np.diff([-np.log(s / (1 - s)) for s in share]), 0.05))
    start = np.concatenate([np.zeros(dim), [first], gaps])

    def thresholds(x):
        return x[dim] + np.concatenate([[0.0], np.cumsum(np.exp(x[dim + 1:]))])

    def gradient(x):
        score, t = X.dot(x[:dim], feature, owner, n), thresholds(x)
        above = np.concatenate([np.ones((1, n)), _sigmoid(score[None, :] - t[:, None]), np.zeros((1, n))])
        slope = above * (1 - above)                     # of P(grade >= j) in score, j = 0 .. top + 1
        p = np.maximum(above[grade, np.arange(n)] - above[grade + 1, np.arange(n)], 1e-12)
        lower, upper = slope[grade, np.arange(n)] / p, slope[grade + 1, np.arange(n)] / p
        by_score = -(lower - upper) / n
        by_t = np.array([(np.where(grade == j, lower, 0) - np.where(grade == j - 1, upper, 0)).sum() / n
                         for j in range(1, top + 1)])
        out = np.empty_like(x)
        out[:dim] = (np.bincount(feature, weights=by_score[owner], minlength=dim) + RIDGE * x[:dim])
        out[dim] = by_t.sum()
        out[dim + 1:] = [by_t[j:].sum() * np.exp(x[dim + j]) for j in range(1, top)]
        return out

    x = X.adagrad(gradient, start, STEPS, RATE)
    weights = np.zeros(X.DIM)
    weights[kept] = x[:dim]
    return weights, thresholds(x)


def usable(by_class: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The features that ``fit`` or ``grades`` may use: the telling ones and all that can be markers."""
    return X.telling_classes(by_class, size, LEAST_DOCS, CHI2) | (by_class[-1] >= LEAST_DOCS)


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS):
    """(weights, thresholds), or None without labels of both kinds."""
    feature, count, owner, label = X.sample(docs, labels, {"toxic": F.col("toxic")}, rows, usable)
    toxic = (label["toxic"] > 0).astype(np.int64)
    if not 0 < toxic.sum() < len(toxic):
        return None
    return fit(feature, owner, grades(feature, count, owner, toxic))


def score(docs: DataFrame, model) -> DataFrame:
    """One row per document: (doc_id, severity, p_toxic, p_severe, grade, toxic)."""
    weights, thresholds = model if model else (np.zeros(X.DIM), np.full(GRADES, np.inf))
    weights = weights.astype(np.float32)

    def run(batches):
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for i, j in S.chunks(offs):
                f, _, o, _ = X.of_texts(data, offs[i:j + 1])
                above = _sigmoid(X.dot(weights, f, o, j - i)[None, :] - thresholds[:, None])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(above.sum(0)), pa.array(above[0]), pa.array(above[-1]),
                     pa.array((above >= 0.5).sum(0).astype(np.int32)), pa.array(above[0] >= 0.5)],
                    ["doc_id", "severity", "p_toxic", "p_severe", "grade", "toxic"])

    return texts(docs).mapInArrow(
        run, "doc_id bigint, severity double, p_toxic double, p_severe double, grade int, toxic boolean")


def severity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    return score(docs, train(docs, labels, rows))
