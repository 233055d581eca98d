"""Mixing documents to target weights with soft domain membership.

Domains come from the label table: ``low`` (quality 0), ``toxic`` (quality 1, toxic 1) and ``clean``. A
multinomial classifier fitted on a bounded sample of labelled documents (``rows``) gives every
document posteriors p_d. Rates r >= 0 minimise

    1/2 sum_d (sum_i r_i q_i p_id - w_d)^2 / m_d  +  mu/2 sum_i q_i (r_i - 1)^2

(q_i: the document's share of all tokens, w_d: target weight, m_d = sum_i q_i p_id) by projected
gradient descent from r = 1, with momentum. A step needs the domains' expected token totals only, one aggregation over
all documents; since every document starts at 1, its rate is the same fold over the steps'
multipliers everywhere, so rates are written every ``FOLDED`` steps only. The total of tokens is kept.

A document is then taken floor(r + u) times, u being a hash of doc_id and text in [0, 1).

Tokens are words (``shingles``). Defined cases: a NULL or empty text has no tokens and its rate moves no total;
repeated rows are separate documents with equal rates; domains without labels are left out and the
other targets scaled to 1; without labels every rate is 1.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import features as X
from pitpanel.llm import shingles as S
from pitpanel.llm.base import staged, texts

log = logging.getLogger(__name__)
ROWS = 12_000
LEAST_DOCS, CHI2 = 5, 20.0     # features in fewer sampled documents, or unrelated to the label, get no weight
STEPS, RATE, RIDGE = 120, 0.3, 2e-4
DOMAINS = ("clean", "toxic", "low")
TARGETS = {"clean": 0.92, "toxic": 0.04, "low": 0.04}
CEILINGS = ("toxic", "low")      # for ``ceilings=``: targets as upper limits; such a domain is then never raised
MU, TOLERANCE = 1e-5, 1e-4         # so weak a pull to 1 moves no weight by the tolerance
FOLDED = 10                      # steps between two writings of the rates
PATIENCE, LEAST_GAIN = 12, 0.01  # descent ends after so many steps that come no nearer by this share


def fit(feature: np.ndarray, owner: np.ndarray, label: np.ndarray, classes: int) -> np.ndarray:
    """(classes, DIM + 1) weights and biases of a ridge-penalised multinomial regression."""
    n = len(label)
    weight = X.telling(feature, owner, label, classes, LEAST_DOCS, CHI2)
    kept, feature, owner = X.compact(weight, feature, owner)
    dim = len(kept)
    share = np.bincount(label, minlength=classes) / n
    start = np.zeros((classes, dim + 1))
    start[:, -1] = np.log(np.maximum(share, 1e-6))
    is_class = np.eye(classes)[label]

    def gradient(x):
        err = (posteriors(x, feature, owner, n) - is_class) / n
        out = np.empty_like(x)
        for d in range(classes):
            out[d, :-1] = (np.bincount(feature, weights=err[owner, d], minlength=dim) + RIDGE * x[d, :-1])
        out[:, -1] = err.sum(0)
        return out

    x = X.adagrad(gradient, start, STEPS, RATE)
    out = np.zeros((classes, X.DIM + 1))
    out[:, kept], out[:, -1] = x[:, :-1], x[:, -1]
    return out


def posteriors(x: np.ndarray, feature: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    z = np.stack([X.dot(w[:-1], feature, owner, n) + w[-1] for w in x], axis=1)
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def classify(docs: DataFrame, labels: DataFrame, rows: int = ROWS, keep: tuple = ()) -> tuple:
    """((doc_id, n_tokens, u, p array<double>, *keep), names of the domains that have labels); ``keep`` may name the text."""
    domain = F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 0)
    feature, _, owner, label = X.sample(docs, labels, {"domain": domain}, rows,
                                        lambda by_class, size: X.telling_classes(by_class, size, LEAST_DOCS, CHI2))
    present, label = np.unique(label["domain"], return_inverse=True)
    names = [DOMAINS[i] for i in present]
    x = fit(feature, owner, label, len(names)).astype(np.float32) if names else None

    def run(batches):
        for b in batches:
            data, offs = S.utf8(b.column("text"))
            for i, j in S.chunks(offs):
                f, _, o, words = X.of_texts(data, offs[i:j + 1])
                p = posteriors(x, f, o, j - i) if x is not None else np.zeros((j - i, 0))
                ends = pa.array((np.arange(j - i + 1) * p.shape[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(words.astype(np.int64)), b.column("u").slice(i, j - i),
                     pa.ListArray.from_arrays(ends, pa.array(p.astype(np.float64).ravel())),
                     *[b.column(c).slice(i, j - i) for c in keep]], ["doc_id", "n_tokens", "u", "p", *keep])

    hashed = F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    d = texts(docs, *[c for c in keep if c != "text"]).withColumn("u", hashed)
    more = "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(run, "doc_id bigint, n_tokens bigint, u double, p array<double>" + more), names


def fold(steps: list, state: F.Column) -> F.Column:
    """A document's (r, before) after the given steps from ``state``: the rate and the one of the step before. A
    step is one multiplier per domain and its momentum."""
    if not steps:
        return state
    history = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in steps])
    domains, eta = len(steps[0]) - 1, 1 / (1 + MU)

    def step(s, lam):
        y = ahead(s, F.element_at(lam, -1))
        pull = F.aggregate(F.zip_with("p", F.slice(lam, 1, domains), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return F.struct(F.greatest(y - eta * (pull + MU * (y - 1)), F.lit(0.0)).alias("r"), s["r"].alias("before"))
    return F.aggregate(history, state, step)


def ahead(state: F.Column, momentum) -> F.Column:
    """The point at which the next gradient is taken."""
    return F.greatest(state["r"] + momentum * (state["r"] - state["before"]), F.lit(0.0))


def rates(members: DataFrame, names: list, targets: dict = TARGETS, ceilings: tuple = ()) -> tuple:
    """(``members`` with ``rate`` and ``copies``, reached weights by domain). Targets are matched; only a
    domain of ``ceilings`` is not raised to its target, and what it lacks goes to the other domains.
    Descent goes on until the weights are within ``TOLERANCE`` or no longer come nearer (targets that no rates
    reach, say of a domain that no document belongs to); every ``FOLDED`` steps the rates are
    written, so that a step's cost does not grow with the steps before it."""
    if not names:
        return members.withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1)), {}
    w = np.array([targets.get(n, 0.0) for n in names])
    w = w / w.sum() if w.sum() > 0 else np.full(len(names), 1 / len(names))

    def totals(rows, rate):
        row = rows.agg(F.sum("n_tokens").alias("t"),
                       *[F.sum(rate * F.col("n_tokens") * F.get("p", F.lit(i))) for i in range(len(names))]).first()
        return np.array([v or 0.0 for v in row[1:]], dtype=float) / max(row[0] or 0, 1)

    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("before"))
    rows, state, steps, momentum, pace = members, start, [], 0.0, 1.0
    mass = reached = totals(members, F.lit(1.0))
    limited = np.array([n in ceilings for n in names])
    if not limited.all() and mass.sum() > 0:
        w = np.where(limited, np.minimum(w, mass), w)
        w[~limited] *= (1 - w[limited].sum()) / max(w[~limited].sum(), 1e-12)
    nearest, since, last = np.inf, 0, np.inf
    while mass.sum() > 0:
        far = np.abs(reached - w).max()
        nearest, since = (far, 0) if far < nearest * (1 - LEAST_GAIN) else (nearest, since + 1)
        if far <= TOLERANCE or since >= PATIENCE:
            break
        if far > last:                                            # momentum overshoots: begin anew
            pace, momentum = 1.0, 0.0
        last = far
        steps.append([*((reached - w) / np.maximum(mass, 1e-12)).tolist(), momentum])
        pace, faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2, pace
        momentum = (faster - 1) / pace
        if len(steps) == FOLDED:
            rows, state, steps = staged(rows.withColumn("state", fold(steps, state)), "mix-rates"), F.col("state"), []
        reached = totals(rows, ahead(fold(steps, state), F.lit(momentum)))
    out = (rows.withColumn("rate", ahead(fold(steps, state), F.lit(momentum))).drop("state")
           .withColumn("copies", F.floor(F.col("rate") + F.col("u")).cast("int")))
    return out, dict(zip(names, reached.tolist()))


def report(names: list, targets: dict, reached: dict) -> None:
    total = sum(targets.get(n, 0.0) for n in names) or 1.0
    told = ", ".join(f"{n} target {targets.get(n, 0.0) / total:.4f} reached {reached[n]:.4f}" for n in names if n in reached)
    missed = any(abs(reached[n] - targets.get(n, 0.0) / total) > 2 * TOLERANCE for n in reached)
    (log.warning if missed else log.info)("mixing: %s", told or "no labelled domain")


def mix(docs: DataFrame, labels: DataFrame, targets: dict = TARGETS, rows: int = ROWS, ceilings: tuple = ()) -> DataFrame:
    """One row per document: (doc_id, n_tokens, p_<domain>..., rate, copies, reached_<domain>...): the weight that each
    domain reaches under all rates (NULL for a domain without labels)."""
    members, names = classify(docs, labels, rows)
    out, reached = rates(staged(members, "mix"), names, targets, ceilings)
    report(names, targets, reached)
    p = [F.get("p", F.lit(names.index(n))).alias(f"p_{n}") if n in names else F.lit(0.0).alias(f"p_{n}") for n in DOMAINS]
    got = [F.lit(reached.get(n)).cast("double").alias(f"reached_{n}") for n in DOMAINS]
    return out.select("doc_id", "n_tokens", *p, "rate", "copies", *got)


def mixed(docs: DataFrame, labels: DataFrame, targets: dict = TARGETS, rows: int = ROWS, ceilings: tuple = ()) -> DataFrame:
    """The documents, each as often as its rate asks for, with their columns."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    inner = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    members, names = classify(inner, labels, rows, ("text", *[f"k{i}" for i in range(len(keep))]))
    out, reached = rates(staged(members, "mix"), names, targets, ceilings)
    report(names, targets, reached)
    again = out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select("doc_id", "text", *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])
