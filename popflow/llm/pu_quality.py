"""Quality by positive-unlabelled learning.

Documents labelled good are trusted positives; documents without a label are unlabelled web text,
a mixture of good and bad. The share of good ones in the mixture (the class prior) is estimated
first: a plain positive-against-unlabelled classifier orders held-back rows, and the prior is the
smallest ratio of unlabelled to positive mass above a threshold, with a term for its uncertainty.
A small network then minimises the non-negative unbiased risk: the positives' loss times the prior
plus the part of the unlabelled loss that positives do not explain, which is not let below zero.
Labels of bad documents are never used.

Features are column expressions over the whole text, and so is the trained network: scoring is one
scan without Python and without a shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm import cascade
from popflow.llm.common import let, words_of
from popflow.llm.labels import one_label, share_below
from popflow.session import cut

HIDDEN = 12
CLIP = 6.0


class Network(NamedTuple):
    """Means and scales of the features, both layers, and the class prior."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    prior: float


def features(text: Column) -> list[Column]:
    """Shape of a text; every feature is finite, also for empty and very long texts."""
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(cascade.n_words(text), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    lines = F.greatest(F.size(F.split(text, "\n")), F.lit(1)).cast("double")

    def count_of(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    return [
        F.log1p(n),
        F.log1p(cascade.word_chars(text) / n),
        F.log1p(10 * cascade.n_symbols(text) / n),
        cascade.upper_share(text),
        cascade.n_stutters(text) / n,
        let(words_of(text), lambda w: F.size(F.array_distinct(w))) / n,
        cascade.n_dup_lines(text) / lines,
        F.log1p(10 * count_of(r"[!?]") / n),
        count_of(r"[0-9]") / chars,
        F.log1p(10 * count_of(r"[.,;:]") / n),
        F.log1p(lines / n * 10),
    ]


def _forward(x: np.ndarray, inner: np.ndarray, outer: np.ndarray):
    hidden = np.tanh(np.c_[x, np.ones(len(x))] @ inner)
    return hidden, np.c_[hidden, np.ones(len(x))] @ outer


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 600,
    rate: float = 0.02, ridge: float = 1e-4, seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """Layers that minimise the non-negative risk; without a prior, positives against the rest."""
    rng = np.random.default_rng(seed)
    x = np.vstack([positive, unlabelled])
    is_p = np.arange(len(x)) < len(positive)
    n_p, n_u = len(positive), len(unlabelled)
    layers = [rng.normal(0, 0.5, (x.shape[1] + 1, HIDDEN)), rng.normal(0, 0.5, HIDDEN + 1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    with_one = np.c_[x, np.ones(len(x))]
    for step in range(1, steps + 1):
        hidden, z = _forward(x, *layers)
        s = _sigmoid(z)
        if prior is None:
            slope = np.where(is_p, (s - 1) / n_p, s / n_u)
        else:
            # The loss of z as a positive has slope s - 1, as a negative s.
            as_negative = np.logaddexp(0, z)
            bad = as_negative[~is_p].mean() - prior * as_negative[is_p].mean()
            negative = np.where(is_p, -prior * s / n_p, s / n_u)
            positive_part = np.where(is_p, prior * (s - 1) / n_p, 0.0)
            # Where the unlabelled remainder has become negative, only that is undone.
            slope = positive_part + negative if bad >= 0 else -negative
        g_outer = np.c_[hidden, np.ones(len(x))].T @ slope
        g_hidden = np.outer(slope, layers[1][:-1]) * (1 - hidden ** 2)
        grads = [with_one.T @ g_hidden + ridge * layers[0], g_outer + ridge * layers[1]]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            layers[i] = layers[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return layers[0], layers[1]


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled scores, from the purest top part of the order."""
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(np.r_[p, u])
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = sum(np.sqrt(np.log(4 / delta) / (2 * len(v))) for v in (p, u))
    ok = above_p > 0
    ratio = above_u[ok] / above_p[ok]
    best = np.argmin(ratio + slack / above_p[ok])
    return float(np.clip(ratio[best], 0.02, 0.98))


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, column: str = "quality",
    max_docs: int = 8000,
) -> Network | None:
    """Learn from about ``max_docs`` positives and as many unlabelled documents at most.

    ``learn`` says which documents may be used. Without positives or unlabelled documents there is
    no model.
    """
    rows = docs.filter(learn & F.col("doc_id").isNotNull()).select("doc_id", "text")
    good = one_label(labels, column).filter("label = 1")
    total, n_good = rows.count(), good.count()

    def share(n: int) -> Column:
        return F.lit(min(1.0, max_docs / max(1, n)))

    chosen = good.filter(share_below(F.col("doc_id"), share(n_good), "good")).select("doc_id")
    known = labels.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    # About max_docs ids; the rows that stay are as few, so their features are collected.
    positives = rows.join(F.broadcast(chosen), "doc_id")
    others = rows.filter(share_below(F.col("doc_id"), share(total), "web")).join(
        known, "doc_id", "left_anti")
    parts = cut(positives.withColumn("good", F.lit(1)).unionByName(
        others.withColumn("good", F.lit(0))).select(
            "good", "doc_id", F.array(*features(F.col("text"))).alias("x")))
    got = parts.orderBy("good", "doc_id", "x").collect()
    x = {v: np.array([r["x"] for r in got if r["good"] == v], float) for v in (1, 0)}
    if not len(x[1]) or not len(x[0]):
        return None
    both = np.vstack([x[1], x[0]])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x[v] - mean) / scale, -CLIP, CLIP) for v in (1, 0))
    rng = np.random.default_rng(1)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    half_p, half_u = len(p) // 2, len(u) // 2
    prior = 0.5
    if half_p and half_u:
        layers = train(p[:half_p], u[:half_u], None)
        prior = class_prior(_forward(p[half_p:], *layers)[1], _forward(u[half_u:], *layers)[1])
    return Network(mean, scale, *train(p, u, prior), prior)


def score_of(text: Column, network: Network | None) -> Column:
    """Probability that the text is good, as a column; 0.5 without a model."""
    if network is None:
        return F.lit(0.5)

    def of(x: Column) -> Column:
        def total(terms: list[Column]) -> Column:
            return reduce(lambda a, b: a + b, terms)

        z = [F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), (x[i] - float(m)) / float(s)))
             for i, (m, s) in enumerate(zip(network.mean, network.scale))]
        return let(F.array(*z), lambda v: total(
            [F.tanh(total([v[i] * float(w) for i, w in enumerate(line[:-1])]) + float(line[-1]))
             * float(o) for line, o in zip(network.inner.T, network.outer[:-1])])
            + float(network.outer[-1]))

    z = let(F.array(*features(text)), of)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def score(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``goodness`` from 0 to 1; null counts as empty text.

    An input column ``goodness`` is replaced. Texts are read whole, however long; equal texts, in
    repeated rows or not, have equal scores, so ties are left as they are. A table without rows
    stays so.
    """
    return docs.withColumn("goodness", score_of(F.col(text), network))
