"""Toxicity by class-conditional Kneser-Ney models.

For each class, every word of all labelled documents is counted by the number of different words
before it, as Kneser-Ney does; the counts are discounted, and the discounted mass
goes to the same counts over both classes. Every word has a log ratio of its two probabilities. Words
that the discount leaves nothing of in either class, and those never seen, all have the one of the two
discounted masses, so the model is that number and a list of the other words. (Models of word pairs over
this one were tried; they lowered held-out accuracy, as pairs of ordinary words are rare in the small
class.)

A text's evidence is the difference of its two log-likelihoods divided by its number of words, kept
apart by how strong the log ratios are: the few words that tell the classes apart must not drown in the
many that hardly do, yet all of them count. A
logistic curve, fitted on a fold of the documents that the counts leave out, turns it into a score;
the sums of its steps are made where the rows are. A caller may bound the documents of a class. Then
a row of the fold weighs as many rows as it stands for, since the classes are sampled at shares of
their own and the curve must keep the odds of the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import word_hashes
from popflow.llm.labels import one_label, perhaps_in, sample_ids
from popflow.session import cut

DISCOUNT = 2.0
MARGIN = 2.0
_BANDS = (0.25, 0.5, 1.0, 1.5)  # borders of weak and strong log ratios, in margins
_PARTS = 32  # of a word's pairs
_START = np.uint64(0x5BD1E9955BD1E995)  # stands before the first word


class Model(NamedTuple):
    """Sorted hashes of words, their log ratios and that of all other words, the curve."""

    words: np.ndarray
    ratio: np.ndarray
    rest: float
    margin: float
    curve: tuple[float, ...]


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _before(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.empty_like(words)
    out[1:] = words[:-1]
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    out[firsts] = _START
    return out


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each (before, word): the documents of each class in a batch of (text, label) with it."""
    for batch in batches:
        words, counts = word_hashes(_texts(batch.column("text")), lower=True)
        if not len(words):
            continue
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(counts)), counts)
        rows = np.stack([text, words.view(np.int64), _before(words, counts).view(np.int64)])
        rows = rows[:, np.lexsort(rows)]
        first = np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(0)]  # once per document
        text, word, before = rows[:, first]
        new = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (before[1:] != before[:-1])])
        toxic = np.add.reduceat(label[text], new)
        n = np.diff(np.r_[new, len(word)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(before[new]), pa.array(word[new]), pa.array(toxic), pa.array(n - toxic)],
            names=["before", "word", "toxic", "plain"])


def _log_ratios(pairs: DataFrame, discount: float) -> tuple[DataFrame, float]:
    """(word, ratio) of the words with more than ``discount`` in a class, and the ratio of all others."""
    # The pairs of a word lie in ``_PARTS`` places at most, however many tasks there are.
    words = cut(pairs.groupBy("word", "part").agg(
        F.count(F.when(F.col("toxic") > 0, 1)).alias("t"),
        F.count(F.when(F.col("plain") > 0, 1)).alias("o"),
        F.count(F.lit(1)).alias("s")).groupBy("word").agg(*[F.sum(c).alias(c) for c in "tos"]))

    def left(c: str) -> Column:
        return F.greatest(F.col(c) - discount, F.lit(0.0))

    sums = words.agg(*[F.sum(c).cast("double").alias(f"n_{c}") for c in "tos"],
                     *[F.sum(left(c)).alias(f"kept_{c}") for c in "to"],
                     F.count(F.lit(1)).cast("double").alias("v")).first()
    if not sums["v"]:
        return words.select("word", F.lit(0.0).alias("ratio")), 0.0
    total = {c: max(sums[f"n_{c}"], 1.0) for c in "to"}
    lost = {c: 1 - sums[f"kept_{c}"] / total[c] for c in "to"}
    shared = (F.col("s") + 0.5) / (sums["n_s"] + 0.5 * sums["v"])
    toxic, plain = (left(c) / total[c] + lost[c] * shared for c in "to")
    return words.filter((F.col("t") > discount) | (F.col("o") > discount)).select(
        "word", F.log(toxic / plain).alias("ratio")), math.log(lost["t"] / lost["o"])


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words and ratios of a batch as one row of raw numbers."""
    for batch in batches:
        word, ratio = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("word", "ratio"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([word.astype(np.int64).tobytes()], pa.binary()),
             pa.array([ratio.astype(np.float32).tobytes()], pa.binary())], names=["word", "ratio"])


def evidence(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Difference of the log-likelihoods per word, by strength of the log ratios, 0 without words;
    and the number of words."""
    words, counts = word_hashes(texts, lower=True)
    ratio = np.full(len(words), model.rest)
    if len(model.words):
        at = np.minimum(np.searchsorted(model.words, words), len(model.words) - 1)
        ratio = np.where(model.words[at] == words, model.ratio[at], model.rest)
    n = len(_BANDS) + 1
    band = np.searchsorted(np.array(_BANDS) * model.margin, np.abs(ratio), "right")
    sums = np.bincount(np.repeat(np.arange(len(counts)), counts) * n + band, ratio, n * len(counts))
    return sums.reshape(-1, n) / np.maximum(counts, 1)[:, None], counts


def _spread(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The evidence on a scale where a single strong word in a long text still shows."""
    x = x.reshape(len(counts), -1)
    root = np.sqrt(np.maximum(counts, 1))[:, None]
    return np.concatenate(
        [np.arcsinh(300 * x), np.arcsinh(10 * x * root), np.ones((len(x), 1))], axis=1)


def _numbers(column: pa.Array) -> np.ndarray:
    """Numbers, or as many of each row."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False).astype(float)


def _curve_sums(w: np.ndarray):
    """Gradient and curvature of the curve ``w`` over the rows of a task, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(w) * (len(w) + 1))
        for batch in batches:
            label, weight, found, counts = (
                _numbers(batch.column(c)) for c in ("label", "weight", "evidence", "words"))
            if not len(label):
                continue
            x = _spread(found, counts)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            total += np.r_[x.T @ (weight * (p - label)),
                           ((x * (weight * p * (1 - p))[:, None]).T @ x).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])
    return run


def _fit_curve(held: DataFrame, k: int = 3, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression of weighted rows by Newton steps with a small ridge.

    A step brings a dozen sums of each task to the driver.
    """
    w = np.zeros(k)
    ridge = np.diag([1e-2] * (k - 1) + [1e-4])
    for _ in range(rounds):
        parts = held.mapInArrow(_curve_sums(w), "sums array<double>").collect()
        total = np.array([math.fsum(v) for v in zip(*[p["sums"] for p in parts])])
        step = np.linalg.solve(total[k:].reshape(k, k) + ridge, total[:k] + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w)


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, column: str = "toxic",
    max_docs: int | None = None, max_bytes: int | None = None, folds: int = 4,
    discount: float = DISCOUNT, margin: float = MARGIN,
) -> Model:
    """Learn from all documents with a label.

    ``max_docs`` and ``max_bytes`` bound the documents and bytes of text per class. ``margin`` is the
    log ratio from which a word counts as a strong one; all words count. ``train`` says which documents may be learnt from. One fold in ``folds`` fits the curve, the
    others the counts. Without documents of both classes the score is 0.5 for every text.
    """
    rows = docs.filter(train & F.col("doc_id").isNotNull())
    known = one_label(labels, column)
    if max_docs is None and max_bytes is None:
        chosen = known.withColumn("weight", F.lit(1.0))
    else:
        sized = cut(rows.select(
            "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).join(
                known, "doc_id"))
        chosen = sample_ids(sized, "label", max_docs or 1 << 62, max_bytes or 1 << 62, "toxicity")
    # Three numbers a document; written, so that its size is known where it meets the texts.
    chosen = cut(chosen.select("doc_id", "label", "weight").distinct())
    # Both grow with the documents: joined by sorting, only texts that may have a label moving.
    learnt = perhaps_in(rows.select("doc_id", "text"), chosen).join(
        chosen.hint("merge"), "doc_id").select(
        "text", "label", "weight",
        F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(folds)).alias("fold"))
    counted = learnt.filter("fold > 0").select("text", "label").mapInArrow(
        _count_pairs, "before bigint, word bigint, toxic bigint, plain bigint")
    # A batch has each pair once already; the same exchange serves the pairs and their words.
    pairs = counted.select(
        "before", "word", F.pmod("before", F.lit(_PARTS)).alias("part"), "toxic", "plain"
    ).repartition("word", "part").groupBy("word", "part", "before").agg(
        F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    listed, rest = _log_ratios(pairs, discount)
    # Two numbers, 12 bytes, of each word that is more than its share of the rest.
    raw = listed.mapInArrow(_as_bytes, "word binary, ratio binary").collect()
    keys = np.frombuffer(b"".join(r["word"] for r in raw), np.uint64)
    order = np.argsort(keys)
    model = Model(keys[order], np.frombuffer(b"".join(r["ratio"] for r in raw), np.float32)[order],
                  rest, margin, ())
    held = cut(learnt.filter("fold = 0").select("text", "label", "weight").mapInArrow(
        _evidence_rows(model, ["label", "weight"]),
        "label int, weight double, evidence array<double>, words bigint"))
    if held.select("label").distinct().count() < 2:
        return model._replace(curve=())
    return model._replace(curve=_fit_curve(held, 2 * len(_BANDS) + 3))


def _evidence_rows(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = evidence(_texts(batch.column("text")), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [
                    pa.FixedSizeListArray.from_arrays(found.ravel(), found.shape[1]).cast(
                        pa.list_(pa.float64())), pa.array(counts.astype(np.int64))],
                names=[*keep, "evidence", "words"])
    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1 instead of the text; null counts as empty text.

    Other columns of any name stay as they are; an input column ``toxicity`` is replaced. Texts are
    read whole, however long; equal texts, in repeated rows or not, have equal scores, so ties are
    left as they are. A table without rows stays so.
    """
    named = {c: f"c{i}" for i, c in enumerate(
        c for c in docs.columns if c not in (text, "toxicity"))}
    rest = list(named.values())
    rows = docs.select(*[F.col(c).alias(n) for c, n in named.items()], F.col(text).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*rest).schema)
    curve = model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _evidence_rows(model, rest)(batches):
            x = _numbers(out.column("evidence"))
            if curve and len(x):
                z = _spread(x, out.column("words").to_numpy()) @ np.array(curve)
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                p = np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [out.column(i) for i in range(len(rest))] + [pa.array(p)],
                names=[*rest, "toxicity"])

    return rows.mapInArrow(run, f"{schema}, toxicity double").withColumnsRenamed(
        {n: c for c, n in named.items()})
