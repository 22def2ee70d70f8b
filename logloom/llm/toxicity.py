"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each has a linear model over hashed word beginnings,
and every model after the first also sees the probabilities of the categories before it. While
fitting, those probabilities are out of fold: a model learns from the predictions that earlier
models make for documents they have not seen, as they will have to when scoring.

The models are fitted on the driver from a sample of at most ``sample_rows`` labelled documents
(the documented bound); every document is scored in full by tasks.

Contract: null text counts as empty. Labels that are null are left out; of repeated labels of a
document the largest counts. A category without two classes is predicted by its share; without any
labelled document nothing is toxic. Every row gives a row, and repeated rows repeat.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain as chained

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.memory import Memo, at_work, slices

SAMPLE_ROWS = 6000
FOLDS = 3
DIMENSIONS = 1 << 20
# Odd factor that gives the second place of a feature that occurs again.
AGAIN = 0x9E3779B1
# Beginnings of words that count as features.
BEGINNINGS = (4, 5, 6, 7, 9)
THRESHOLD = 0.3
# A feature counts from this z score on; what is less telling would only add noise to long texts.
LEAST_Z = 5.0
# Bytes of runs that a worker remembers, and of text that is scored together.
MEMO_BYTES = 96 << 20
STEP_BYTES = 2 << 20

_MARKS = re.compile(r"[^\w\s]{2,}")
_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Hashed features of texts; what a run of characters gives is remembered."""

    def __init__(self) -> None:
        self.known = Memo(MEMO_BYTES)

    @staticmethod
    def _of(run: str) -> tuple[int, ...]:
        words, low = _WORD.findall(run), run.lower()
        names = {f"{n}:{w[:n]}" for w in _WORD.findall(low) for n in BEGINNINGS if len(w) >= n}
        names |= {f"mark:{x[:3]}" for x in _MARKS.findall(run)} | {"capitals" for w in words if len(w) > 1 and w.isupper()}
        return tuple(zlib.crc32(x.encode()) % DIMENSIONS for x in names)

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text its features, and for those of two or more different runs a second one."""
        runs = [set((x or "").split()) for x in texts]
        for run in self.known.missing(set().union(*runs)):
            ids = self._of(run)
            self.known.put(run, ids, 36 * len(ids))
        young, found = self.known.young, []
        for own in runs:
            ids, counts = np.unique(np.fromiter(chained.from_iterable(map(young.__getitem__, own)), np.int64), return_counts=True)
            found.append(np.unique(np.concatenate([ids, ids[counts > 1] * AGAIN % DIMENSIONS])).astype(np.int32))
        self.known.settle()
        return found


@dataclass
class Rows:
    """Sparse binary rows and dense extra columns."""

    ids: np.ndarray
    ends: np.ndarray
    extra: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        ends = np.cumsum([len(x) for x in rows], dtype=np.int64)
        return cls(np.concatenate(rows) if rows else np.zeros(0, np.int32), ends, np.zeros((len(rows), 0)))

    def take(self, rows: np.ndarray) -> Rows:
        starts = np.append(0, self.ends[:-1])
        parts = Rows.of([self.ids[starts[i] : self.ends[i]] for i in rows])
        return Rows(parts.ids, parts.ends, self.extra[rows])

    def sums(self, weights: np.ndarray) -> np.ndarray:
        total = np.append(0.0, np.cumsum(weights[self.ids]))
        return total[self.ends] - total[np.append(0, self.ends[:-1])]


@dataclass
class Linear:
    """A logistic model: weights of features, of extra columns, and a constant."""

    weights: np.ndarray
    extra: np.ndarray
    constant: float

    def predict(self, rows: Rows) -> np.ndarray:
        return probability(rows.sums(self.weights) + rows.extra @ self.extra + self.constant)


def probability(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -30.0, 30.0)))


def logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))


def telling(rows: Rows, target: np.ndarray, least: float = LEAST_Z) -> np.ndarray:
    """Features whose share among the positive rows differs from that among the others by z."""
    counts = np.diff(np.append(0, rows.ends))
    positive = np.repeat(target, counts)
    some = np.bincount(rows.ids, minlength=DIMENSIONS).astype(float)
    hits = np.bincount(rows.ids, positive, DIMENSIONS)
    n, n_hits = len(target), target.sum()
    share = some / n
    # Half a row of doubt keeps features of single rows from looking certain.
    apart = (hits + 0.5) / (n_hits + 1) - (some - hits + 0.5) / (n - n_hits + 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 0.25 / n) * (1 / n_hits + 1 / (n - n_hits)))
    return np.flatnonzero((np.abs(apart) >= least * spread) & (some >= 3))


def fit_linear(rows: Rows, target: np.ndarray, rounds: int = 300, rate: float = 0.3, penalty: float = 1e-4) -> Linear:
    """Logistic regression over the telling features, by full-batch steps with a rate per weight."""
    share = float(np.clip(target.mean() if len(target) else 0.0, 1e-6, 1 - 1e-6))
    model = Linear(np.zeros(DIMENSIONS), np.zeros(rows.extra.shape[1]), float(logit(np.array(share))))
    if not 0 < target.sum() < len(target):
        return model
    used = telling(rows, target)
    counts = np.diff(np.append(0, rows.ends))
    owner = np.repeat(np.arange(len(target)), counts)
    column = np.full(DIMENSIONS, -1)
    column[used] = np.arange(len(used))
    place = column[rows.ids]
    owner, place = owner[place >= 0], place[place >= 0]
    weights, extra, constant = np.zeros(len(used)), model.extra, model.constant
    squares = [np.full(len(used), 1e-8), np.full(len(extra), 1e-8), 1e-8]
    for _ in range(rounds):
        score = np.bincount(owner, weights[place], len(target)) + rows.extra @ extra + constant
        error = probability(score) - target
        slopes = (
            np.bincount(place, error[owner], len(used)) / len(target) + penalty * weights,
            rows.extra.T @ error / len(target) + penalty * extra,
            float(error.mean()),
        )
        squares = [s + g * g for s, g in zip(squares, slopes)]
        weights = weights - rate * slopes[0] / np.sqrt(squares[0])
        extra = extra - rate * slopes[1] / np.sqrt(squares[1])
        constant = constant - rate * slopes[2] / np.sqrt(squares[2])
    model.weights[used] = weights
    model.extra, model.constant = extra, float(constant)
    return model


def fit_chain(rows: Rows, targets: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per column of ``targets``, each fed with out-of-fold predictions of those before."""
    chain, fold = [], np.arange(len(targets)) % folds
    for k in range(targets.shape[1]):
        target = targets[:, k].astype(float)
        chain.append(fit_linear(rows, target))
        if k + 1 == targets.shape[1]:
            break
        unseen = np.zeros(len(targets))
        for f in range(folds):
            seen, held = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            unseen[held] = fit_linear(rows.take(seen), target[seen]).predict(rows.take(held))
        rows = Rows(rows.ids, rows.ends, np.column_stack([rows.extra, logit(unseen) / 10]))
    return chain


def predict_chain(chain: list[Linear], rows: Rows) -> np.ndarray:
    """Probabilities, one column per category."""
    found = []
    for model in chain:
        p = model.predict(rows)
        found.append(p)
        rows = Rows(rows.ids, rows.ends, np.column_stack([rows.extra, logit(p) / 10]))
    return np.column_stack(found) if found else np.zeros((len(rows.ends), 0))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with at_work(Features) as features:
        yield from _gather_with(features, batches)


def _gather_with(features: Features, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", STEP_BYTES):
            ids = pa.array(features.ids(batch.column("text").to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("targets"), ids], ["doc_id", "targets", "ids"])


def train_chain(docs: DataFrame, labels: DataFrame, categories: list, sample_rows: int = SAMPLE_ROWS, folds: int = FOLDS) -> list[Linear]:
    """The chain for ``categories``, columns over ``labels`` that give 0 or 1.

    The sample is the first ``sample_rows`` labelled documents in the order of a hash of their id.
    """
    targets = F.array(*[F.max(c.cast("int")) for c in categories]).alias("targets")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(targets)
    known = known.filter(F.forall("targets", lambda x: x.isNotNull()))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    # A document id in very many rows must not make the sample larger.
    found = rows.mapInArrow(_gather, "doc_id bigint, targets array<int>, ids array<int>")
    sample = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("ids")).limit(sample_rows).toArrow()
    ids = [x.values.to_numpy() if len(x) else np.zeros(0, np.int32) for x in sample.column("ids")]
    values = np.array(sample.column("targets").to_pylist(), np.int64).reshape(-1, len(categories))
    return fit_chain(Rows.of(ids), values, folds)


def _scored(batches: Iterator[pa.RecordBatch], chain: Broadcast) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, and the probabilities of their rows."""
    with at_work(Features) as features:
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                yield batch, predict_chain(chain.value, Rows.of(features.ids(batch.column("text").to_pylist())))


def _score(batches: Iterator[pa.RecordBatch], chain: Broadcast, names: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch, found in _scored(batches, chain):
        columns = [pa.array(found[:, k]) for k in range(len(names))]
        verdict = pa.array(found[:, -1] >= threshold)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, verdict], ["doc_id", *names, "toxic"])


def _drop(batches: Iterator[pa.RecordBatch], chain: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch, found in _scored(batches, chain):
        yield batch.filter(pa.array(found[:, -1] < threshold))


def _categories() -> list:
    """The label columns in chain order; the last decides."""
    return [1 - F.col("quality"), F.col("toxic")]


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, p_low_quality, p_toxic, toxic) of every row of ``docs``."""
    chain = docs.sparkSession.sparkContext.broadcast(train_chain(docs, labels, _categories(), sample_rows))
    names = ["p_low_quality", "p_toxic"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, p_low_quality double, p_toxic double, toxic boolean"
    return rows.mapInArrow(partial(_score, chain=chain, names=names, threshold=threshold), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    chain = docs.sparkSession.sparkContext.broadcast(train_chain(docs, labels, _categories(), sample_rows))
    return docs.mapInArrow(partial(_drop, chain=chain, threshold=threshold), docs.schema)
