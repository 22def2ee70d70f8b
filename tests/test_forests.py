from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from logloom.operators import forests, models
from logloom.operators.metrics import cv_results


@pytest.fixture(autouse=True)
def in_tasks(monkeypatch):
    """Forests grow in tasks however small they are."""
    monkeypatch.setattr(models, "SMALL_TREE_ROWS", 0)


@pytest.fixture(scope="module")
def folded(spark):
    """Rows of four features, the second of which mostly gives the target; one entity comes three times, one is null."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        bad = int(i % 3 == 0)
        x = [float(rng.poisson(3)), float(rng.poisson(5 if bad else 1)), round(float(rng.normal()), 3), float(i % 2)]
        name = None if i == 7 else "e5" if i in (50, 90) else f"e{i}"
        rows.append((name, Vectors.dense(x) if i % 2 else Vectors.sparse(4, dict(enumerate(x))), bad, i % 5 + 1))
    return spark.createDataFrame(rows, ["entity_id", "features", "target", "fold"]).selectExpr(
        "entity_id", "features", "cast(target as int) target", "cast(fold as int) fold"
    )


def _scores(df):
    return sorted((r.model, r.fold, str(r.entity_id), r.target, r.prediction, r.score) for r in df.collect())


def test_forests_take_few_jobs_and_do_not_depend_on_partitions(spark, folded):
    """Levels of trees are no jobs, and every row has one score, the same wherever rows lie."""
    config = models.ModelConfig(trees=9)
    spark.sparkContext.setJobGroup("forests", "forests of five folds")
    try:
        first = models.cross_validate(folded.coalesce(1), (models.FOREST,), config)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forests")) < 20
    found = _scores(first)
    assert found == _scores(models.cross_validate(folded.repartition(7), (models.FOREST,), config))
    assert sorted(r[2] for r in found) == sorted(str(r.entity_id) for r in folded.collect())
    assert all(0 <= r[5] <= 1 and r[4] == (r[5] > 0.5) for r in found)
    assert all(r.auc > 0.9 for r in cv_results(first).collect())
    other = models.cross_validate(folded, (models.FOREST,), models.ModelConfig(trees=9, seed=1))
    assert _scores(other) != found


def test_forests_of_tasks_and_of_the_cluster_rank_alike(folded, monkeypatch):
    """A table beyond a task's share still grows in the cluster; held-out rows are ranked as well either way."""
    config = models.ModelConfig(trees=20)
    ours = {r.fold: r.auc for r in cv_results(models.cross_validate(folded, (models.FOREST,), config)).collect()}
    monkeypatch.setattr(forests, "MOST_CELLS", 0)
    monkeypatch.setattr(models, "TREE_ROWS", 300 * 7)
    theirs = models.cross_validate(folded, (models.FOREST,), config)
    assert theirs.count() == 300
    theirs = {r.fold: r.auc for r in cv_results(theirs).collect()}
    assert set(ours) == set(theirs) and abs(np.mean(list(ours.values())) - np.mean(list(theirs.values()))) < 0.03


def test_small_forests_are_those_of_the_library(folded, monkeypatch):
    monkeypatch.setattr(models, "SMALL_TREE_ROWS", 300 * 9)
    monkeypatch.setattr(forests, "fold_scores", None)
    scores = models.cross_validate(folded, (models.FOREST,), models.ModelConfig(trees=9, max_depth=4))
    assert scores.count() == 300


def _grown(rows, target, weight, depth, widths):
    """A tree in the open: (share, None) of a leaf, or (share, (feature, last bin to the left, left, right))."""
    n = sum(weight[i] for i in rows)
    p = sum(weight[i] for i in rows if target[i])
    share, best = Fraction(int(p), int(n)), (0, None)
    if depth and 0 < p < n:
        for f, width in enumerate(widths):
            for cut in range(width - 1):
                a = [i for i in rows if BINS[i][f] <= cut]
                ln, lp = sum(weight[i] for i in a), sum(weight[i] for i in a if target[i])
                if 0 < ln < n:
                    gain = Fraction(int(lp * n - ln * p) ** 2, int(ln * (n - ln)))
                    if gain > best[0]:
                        best = gain, (f, cut, a)
    if best[1] is None:
        return share, None
    f, cut, left = best[1]
    right = [i for i in rows if i not in set(left)]
    one, two = (_grown(part, target, weight, depth - 1, widths) for part in (left, right))
    if one[1] is None and two[1] is None and (one[0] * 2 > 1) == (two[0] * 2 > 1):
        return share, None
    return share, (f, cut, one, two)


BINS = np.random.default_rng(8).integers(0, [5, 3, 1, 9], (160, 4)).astype(np.uint8)


@pytest.mark.parametrize("depth", [0, 1, 3, 30])
def test_trees_equal_plain_recursion(depth, monkeypatch):
    monkeypatch.setattr(forests, "_drawn", lambda rng, nodes, features, picked: np.tile(np.arange(features)[:, None], nodes))
    rng = np.random.default_rng(depth)
    target = rng.integers(0, 2, 160) * (BINS[:, 0] > 1)
    weight = rng.poisson(1.0, 160)
    widths = np.array([5, 3, 1, 9])
    held = np.random.default_rng(3).integers(0, widths, (60, 4)).astype(np.uint8)
    found = forests.tree_shares(BINS, target.astype(float), weight.astype(float), held, widths, 4, depth, rng)
    whole = _grown([i for i in range(160) if weight[i]], target, weight, depth, widths)
    for row, share in zip(held, found):
        node = whole
        while node[1] is not None:
            f, cut, one, two = node[1]
            node = one if row[f] <= cut else two
        assert share == float(node[0])


def test_bounds_and_bins():
    assert list(forests.thresholds(np.array([2.0, 0.0, 2.0, 5.0]), 4)) == [1.0, 3.5]
    assert list(forests.thresholds(np.array([3.0, 3.0]), 2)) == []
    assert list(forests.thresholds(np.array([-1.0, 4.0]), 9)) == [-0.5, 2.0]
    many = forests.thresholds(np.arange(1.0, 641.0), 640)
    assert len(many) == 31 and list(many[:2]) == [20.5, 40.5]
    bins = forests.binned(np.array([[0.0, 7.0], [1.0, 7.0], [1.1, 7.0], [9.0, 7.0]]), [np.array([1.0, 3.5]), np.array([])])
    assert bins.tolist() == [[0, 0], [0, 0], [1, 0], [2, 0]]


def test_features_of_a_node_are_different_and_even():
    drawn = forests._drawn(np.random.default_rng(0), 20_000, 9, 3)
    assert drawn.shape == (3, 20_000) and (np.diff(np.sort(drawn, axis=0), axis=0) > 0).all()
    assert np.abs(np.bincount(drawn.reshape(-1), minlength=9) / 20_000 - 1 / 3).max() < 0.02


def test_logistic_fits_read_few_partitions(folded, monkeypatch):
    """A fold is written by many tasks; the steps of a fit are not as many tasks."""
    seen = []
    plain = models.estimator

    class Watched:
        def __init__(self, fitted):
            self.fitted = fitted

        def fit(self, train):
            seen.append(train.rdd.getNumPartitions())
            return self.fitted.fit(train)

    monkeypatch.setattr(models, "estimator", lambda *a: Watched(plain(*a)))
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    scores = models.cross_validate(folded.repartition(40), (models.LOGISTIC,), models.ModelConfig(max_iter=20))
    assert scores.count() == 300 and len(seen) == 5 and max(seen) <= 3


def test_signature_in_two_steps(spark):
    """The steps of a signature give what it gives at once."""
    from pyspark.sql import functions as F

    from logloom.functions import text
    from logloom.functions.formats import BLOCK_LOG

    lines = ["a  b\t blk_-12 10.0.0.1:80", "", " x ", "plain words", "é ü 7", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    masked = df.select("value", F.explode(F.array(text.mask(F.col("value"), BLOCK_LOG.masks))).alias("masked"))
    rows = masked.select("value", text.even(F.col("masked")).alias("a"), text.signature(F.col("value"), BLOCK_LOG.masks).alias("b"))
    found = rows.collect()
    assert len(found) == 6 and all(r.a == r.b for r in found) and found[0].a == "a b <BLOCK> <IP><NUM>"
