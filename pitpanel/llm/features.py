"""Sparse text features for the classifiers of this subpackage: which words and word
beginnings a text has (hashed), and bins of a few ratios of its characters. Computed with numpy where the text is."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import shingles as S
from pitpanel.llm.base import staged, texts

DIM = 1 << 18
PREFIXES = (4, 5)      # bytes; word beginnings stand for the forms of a word
BINS = 12
_CLASSES = (tuple(b"#*$%&<>"), tuple(b"!?"), tuple(b"|"), tuple(range(65, 91)), tuple(range(48, 58)))
U = np.uint64


def of_texts(data: np.ndarray, offs: np.ndarray) -> tuple:
    """(feature, occurrences, text index, words per text) of the texts between ``offs``."""
    n = len(offs) - 1
    hashes, t = S.words(data, offs, PREFIXES)
    words = np.bincount(t, minlength=n)
    feature, owner, count = [], [], []
    for h in hashes:
        key, times = np.unique(t * DIM + (h & U(DIM - 1)).astype(np.int64), return_counts=True)
        feature.append(key % DIM)
        owner.append(key // DIM)
        count.append(times)
    distinct = np.bincount(owner[0], minlength=n)
    buf = data[offs[0]:offs[-1]]
    ratios = [1 - distinct / np.maximum(words, 1)]
    for chars in _CLASSES:
        member = np.zeros(256, bool)
        member[list(chars)] = True
        before = np.concatenate([[0], np.cumsum(member[buf])])
        ratios.append((before[offs[1:] - offs[0]] - before[offs[:-1] - offs[0]]) / np.maximum(words, 1))
    for i, r in enumerate(ratios):
        place = np.minimum((np.sqrt(np.minimum(r, 4.0)) * (BINS / 2)).astype(np.int64), BINS - 1)
        salt = S.stream(BINS, 101 + i)
        feature.append((salt[place] & U(DIM - 1)).astype(np.int64))
        owner.append(np.arange(n))
        count.append(np.ones(n, np.int64))
    feature, owner, count = np.concatenate(feature), np.concatenate(owner), np.concatenate(count)
    order = np.argsort(owner, kind="stable")
    return feature[order], count[order], owner[order], words


def sample(docs: DataFrame, labels: DataFrame, label: dict, rows: int, choose) -> tuple:
    """Features of about ``rows`` labelled documents - a share chosen by a hash of doc_id - as
    (feature, occurrences, text index, label columns). ``label``: {name: Column over ``labels``};
    rows with a NULL label are left out, a document labelled more than once counts once.
    ``choose``: (classes, DIM) texts by class of the first label and feature, texts by class -> mask of the
    features that a fit can use; only those reach the driver."""
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[c.alias(k) for k, c in label.items()]) \
        .dropna().groupBy("doc_id").agg(*[F.max(k).alias(k) for k in label])
    share = rows / max(marked.count(), 1)
    if share < 1:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = marked.limit(2 * rows)                                  # a bound; about ``rows`` are left
    d = texts(docs).join(F.broadcast(picked), "doc_id")
    names = list(label)

    def run(batches):
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for i, j in S.chunks(offs):
                f, c, o, _ = of_texts(data, offs[i:j + 1])
                ends = pa.array(np.searchsorted(o, np.arange(j - i + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, pa.array(f.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(np.minimum(c, 1 << 30).astype(np.int32))),
                     *[b.column(k).slice(i, j - i).cast(pa.int32()) for k in names]], ["f", "c", *names])

    got = d.select("doc_id", "text", *[F.col(k).cast("int").alias(k) for k in names]).mapInArrow(
        run, "f array<int>, c array<int>, " + ", ".join(f"{k} int" for k in names))
    got = staged(got, "sample")
    size = {r[0]: r[1] for r in got.groupBy(names[0]).agg(F.count(F.lit(1))).collect()}
    classes = sorted(size)
    seen = got.select(names[0], F.explode("f").alias("f")).groupBy(names[0], "f").agg(F.count(F.lit(1)).alias("n")).toArrow()
    by_class = np.zeros((len(classes), DIM), np.int32)
    by_class[np.searchsorted(classes, seen.column(0).to_numpy()), seen.column(1).to_numpy()] = seen.column(2).to_numpy()
    bits = np.packbits(choose(by_class, np.array([size[c] for c in classes])) if classes else np.zeros(DIM, bool))

    def chosen(batches):
        mask = np.unpackbits(bits).astype(bool)
        for b in batches:
            f, offs = b.column("f").flatten().to_numpy(), b.column("f").offsets.to_numpy()
            use = mask[f]
            ends = pa.array(np.concatenate([[0], np.cumsum(use)])[offs - offs[0]].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(f[use])),
                 pa.ListArray.from_arrays(ends, pa.array(b.column("c").flatten().to_numpy()[use])),
                 *[b.column(k) for k in names]], ["f", "c", *names])

    got = got.mapInArrow(chosen, got.schema).limit(2 * rows).toArrow().combine_chunks()   # repeated rows stay bounded too

    def flat(name):
        col = got.column(name)
        chunk = col.chunk(0) if col.num_chunks else pa.array([], pa.list_(pa.int32()))
        return chunk.values.to_numpy(), chunk.offsets.to_numpy()
    f, offs = flat("f")
    c, _ = flat("c")
    f, c = f[offs[0]:offs[-1]], c[offs[0]:offs[-1]]
    return (f, c, np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs)),
            {k: got.column(k).to_numpy().astype(np.int64) for k in names})


def dot(weights: np.ndarray, feature: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the weights of each text's features (each present feature counts 1)."""
    return np.bincount(owner, weights=weights[feature], minlength=n)


def telling(feature: np.ndarray, owner: np.ndarray, label: np.ndarray, classes: int, least_docs: int,
            chi2: float) -> np.ndarray:
    """1.0 for features in ``least_docs`` texts or more whose presence depends on some class (chi-squared
    of class against the rest), else 0.0: the others would only let a model learn the sample's accidents."""
    n = len(label)
    docs = np.bincount(feature, minlength=DIM).astype(float)
    out = np.zeros(DIM, bool)
    for c in range(classes):
        share = max((label == c).mean(), 1e-12)
        inside = np.bincount(feature, weights=(label == c)[owner], minlength=DIM)
        spread = docs * share * (1 - share) * (1 - docs / max(n, 1))
        out |= (inside - docs * share) ** 2 > chi2 * np.maximum(spread, 1e-9)
    return np.where(out & (docs >= least_docs), 1.0, 0.0)


def telling_classes(by_class: np.ndarray, size: np.ndarray, least_docs: int, chi2: float) -> np.ndarray:
    """``telling`` as a mask, from the texts by class and feature and the texts by class."""
    n, docs = size.sum(), by_class.sum(0).astype(float)
    out = np.zeros(DIM, bool)
    for inside, share in zip(by_class, np.maximum(size / n, 1e-12)):
        spread = docs * share * (1 - share) * (1 - docs / n)
        out |= (inside - docs * share) ** 2 > chi2 * np.maximum(spread, 1e-9)
    return out & (docs >= least_docs)


def compact(weight: np.ndarray, feature: np.ndarray, owner: np.ndarray) -> tuple:
    """(kept features, feature numbers among them, owner) of the occurrences of features of weight 1."""
    kept = np.flatnonzero(weight)
    number = np.full(DIM, -1)
    number[kept] = np.arange(len(kept))
    feature = number[feature]
    return kept, feature[feature >= 0], owner[feature >= 0]


def adagrad(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch descent with per-coordinate step sizes."""
    x, seen = start.copy(), np.full(start.shape, 1e-8)
    for _ in range(steps):
        g = gradient(x)
        seen += g * g
        x -= rate * g / np.sqrt(seen)
    return x
