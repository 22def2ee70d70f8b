from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from logloom.operators import metrics as M
from logloom.operators.folds import stratified_folds
from logloom.operators.ranking import number_rows
from logloom.session import stage


def _scores(spark, rows):
    df = spark.createDataFrame(rows, "target int, score double")
    return df.withColumn("prediction", (F.col("score") >= 0.5).cast("int")).withColumn("model", F.lit("m"))


def _auc(rows):
    pos, neg = [s for t, s in rows if t], [s for t, s in rows if not t]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def _curve(rows):
    """Points of all thresholds, those on a straight run left out."""
    levels = sorted({s for _, s in rows}, reverse=True)
    steps = [(sum(s == v and not t for t, s in rows), sum(s == v and t for t, s in rows)) for v in levels]
    keep = [i for i in range(len(steps)) if i in (0, len(steps) - 1) or steps[i] != steps[i + 1]]
    n, p = sum(a for a, _ in steps), sum(b for _, b in steps)
    points = [(sum(a for a, _ in steps[: i + 1]) / n, sum(b for _, b in steps[: i + 1]) / p) for i in keep]
    return [(0.0, 0.0), *points]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(int(rng.random() < 0.4), rng.randint(0, 60) / 60) for _ in range(500)]


@pytest.mark.parametrize("range_rows", [1_000_000, 5])
def test_auc_and_curve(spark, rows, range_rows, monkeypatch):
    monkeypatch.setattr("logloom.operators.ranking.RANGE_ROWS", range_rows)
    scores = _scores(spark, rows)
    assert M.roc_auc(scores).first().auc == pytest.approx(_auc(rows), abs=1e-12)
    curve = sorted((r.fpr, r.tpr) for r in M.roc_curve(scores).collect())
    assert [x for point in curve for x in point] == pytest.approx([x for point in sorted(_curve(rows)) for x in point])
    full = M.roc_curve(scores, ("model",), drop_intermediate=False)
    assert full.count() == len({s for _, s in rows}) + 1


@pytest.mark.parametrize("range_rows", [1_000_000, 7])
def test_numbering(spark, range_rows, monkeypatch):
    monkeypatch.setattr("logloom.operators.ranking.RANGE_ROWS", range_rows)
    keys = random.Random(1).sample(range(10**15), 200)
    df = stage(spark.createDataFrame([(k,) for k in keys], "key bigint"), "test-keys")
    got = {r.key: r.no for r in number_rows(df, "key", "no").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), 1)}


def test_ties_and_single_class(spark):
    assert M.roc_auc(_scores(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])).first().auc == 0.5
    assert M.roc_auc(_scores(spark, [(1, 0.5), (1, 0.7)])).first().auc is None


def test_undefined_precision_and_recall_are_zero(spark):
    row = M.precision_recall(_scores(spark, [(0, 0.1), (1, 0.2)])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)
    row = M.precision_recall(_scores(spark, [(0, 0.1)])).first()
    assert (row.precision, row.recall) == (0.0, 0.0)


def test_best_model_prefers_the_first_on_ties(spark):
    df = spark.createDataFrame([("b", 0.7), ("a", 0.7), ("c", 0.1)], "model string, mean_auc double")
    assert M.best_model(df, ["a", "b", "c"]).first().model == "a"
    assert M.best_model(df, ["b", "a", "c"]).first().model == "b"


def test_folds_are_stratified_and_stable(spark):
    rows = [(f"e{i}", int(i % 7 == 0)) for i in range(1003)]
    df = spark.createDataFrame(rows, "entity_id string, target int")
    first = {r.entity_id: r.fold for r in stratified_folds(df.repartition(1)).collect()}
    assert {r.entity_id: r.fold for r in stratified_folds(df.repartition(13)).collect()} == first
    assert {r.entity_id: r.fold for r in stratified_folds(df, seed=1).collect()} != first
    for target in (0, 1):
        sizes = [sum(first[e] == k for e, t in rows if t == target) for k in range(1, 11)]
        assert max(sizes) - min(sizes) <= 1 and min(sizes) > 0
