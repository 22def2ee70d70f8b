from __future__ import annotations

import numpy as np
import pytest

from logloom.operators import models
from logloom.operators.metrics import cv_results, cv_summary
from logloom.plans.queries import QUERIES
from logloom.plans.train import counts_of_matrix, features_of, train
from logloom.session import stage

SMALL = models.ModelConfig(trees=10, max_depth=5, max_iter=100)


@pytest.fixture(scope="module")
def data(spark):
    """Counts where E2 gives the label away and E4 never varies."""
    rng = np.random.default_rng(0)
    counts, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        cells = {"E1": rng.poisson(5) + 1, "E2": rng.poisson(6 if bad else 1), "E3": rng.poisson(3), "E4": 1}
        counts += [(f"e{i}", event, int(n)) for event, n in cells.items() if n]
        if i % 20 != 1:
            labels.append((f"e{i}", "Anomaly" if bad else "Normal"))
    return (
        stage(spark.createDataFrame(counts, "entity_id string, event_id string, n bigint"), "test-counts"),
        stage(spark.createDataFrame(labels, "entity_id string, label string"), "test-labels"),
    )


def test_train_job(spark, data, tmp_path):
    features, columns = features_of(*data)
    assert columns == ["E1", "E2", "E3"]
    out = str(tmp_path / "model")
    summary = train(spark, features, columns, out, folds=4, config=SMALL)
    rows = {r.model: r for r in summary.collect()}
    assert set(rows) == set(models.MODELS)
    assert all(r.folds == 4 and r.mean_auc > 0.9 and r.mean_recall > 0.5 for r in rows.values())
    scores = spark.read.parquet(f"{out}/scores")
    assert scores.count() == 2 * 240
    assert scores.select("model", "entity_id").distinct().count() == 2 * 240
    assert scores.filter("score < 0 or score > 1").isEmpty()
    assert cv_summary(cv_results(scores)).count() == 2
    best = spark.read.parquet(f"{out}/importance").orderBy("rank").collect()
    assert best[0].feature == "E2" and len(best) == 3
    assert list((tmp_path / "model").glob("model-*/metadata"))


def test_importance_of_both_models(spark, data):
    features, columns = features_of(*data)
    features = stage(features, "test-features")
    for name in models.MODELS:
        model = models.fit_final(name, features, SMALL)
        rows = models.feature_importance(name, model, features, columns, k=2).collect()
        assert [r.rank for r in rows] == [1, 2] and rows[0].feature == "E2"


def test_logistic_penalty_matches_the_summed_objective(spark):
    """The fitted weights are stationary for ``sum(loss) + |w|^2 / 2``."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=200) > 0).astype(int)
    rows = [(f"e{i}", [float(v) for v in x[i]], int(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "entity_id string, x array<double>, target int").withColumn("features", array_to_vector("x"))
    model = models.fit_final(models.LOGISTIC, df)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-2
    assert abs((p - y).sum()) < 1e-2
    assert df.filter(F.size("x") != 3).isEmpty()


def test_features_without_selection(spark, data):
    counts, labels = data
    events = spark.createDataFrame([(f"E{i}",) for i in range(1, 6)], "event_id string")
    _, columns = features_of(counts, labels, variance=None, correlation=None, events=events)
    assert columns == ["E1", "E2", "E3", "E4", "E5"]


def test_counts_of_a_wide_matrix(spark):
    matrix = spark.createDataFrame([("a", 1, 0), ("b", 0, 2)], "entity_id string, E1 bigint, E2 bigint")
    assert sorted(tuple(r) for r in counts_of_matrix(matrix).collect()) == [("a", "E1", 1), ("b", "E2", 2)]


def test_document_model_queries(spark, sf_dir):
    scores = QUERIES["cv_logistic"](spark, sf_dir).collect()
    assert len(scores) == 10 and all(0 <= r.precision <= 1 and 0 <= r.recall <= 1 for r in scores)


def test_sparse_features_equal_the_wide_ones(spark, data):
    from pyspark.ml.linalg import SparseVector

    from logloom.operators.counts import occurrence_matrix
    from logloom.operators.labels import binary_target, join_labels
    from logloom.operators.selection import feature_table, sparse_feature_table

    counts, labels = data
    columns = ["E1", "E2", "E3", "E9"]
    wide = feature_table(binary_target(join_labels(occurrence_matrix(counts, columns), labels), "Anomaly"))
    sparse = sparse_feature_table(counts, columns, labels, "Anomaly").collect()
    assert all(isinstance(r.features, SparseVector) and r.features.size == 4 for r in sparse)
    assert sorted((r.entity_id, tuple(r.features.toArray()), r.target) for r in sparse) == sorted(
        (r.entity_id, tuple(r.features.toArray()), r.target) for r in wide.collect()
    )


def test_train_with_20000_events(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(120):
        bad = i % 3 == 0
        events = {int(k): 1 for k in rng.integers(1, 20001, 30)} | {7: 9 if bad else 1, 20000: 2}
        rows += [(f"e{i}", f"E{k}", n) for k, n in events.items()]
        labels.append((f"e{i}", "Anomaly" if bad else "Normal"))
    counts = stage(spark.createDataFrame(rows, "entity_id string, event_id string, n bigint"), "test-counts")
    labels = spark.createDataFrame(labels, "entity_id string, label string")
    events = spark.createDataFrame([(f"E{i}",) for i in range(1, 20001)], "event_id string")
    features, columns = features_of(counts, labels, variance=None, correlation=None, events=events)
    assert len(columns) == 20000 and features.first().features.size == 20000
    config = models.ModelConfig(trees=2, max_depth=3, max_iter=20)
    summary = train(spark, features, columns, str(tmp_path / "model"), folds=2, config=config)
    assert {r.model: r.mean_auc > 0.8 for r in summary.collect()}[models.LOGISTIC]
    # Selection at this width looks at events that meet, not at all pairs.
    chosen, names = features_of(counts, labels, variance=1e-9, correlation=0.95)
    assert "E7" in names and "E20000" not in names and chosen.count() == 120


def test_large_forests_grow_in_parts(spark, data, monkeypatch, tmp_path):
    """Every tree is there once, no fit grows more than its share, and a fold's model is gone before the last fold."""
    features, columns = features_of(*data)
    config = models.ModelConfig(trees=11, max_depth=5, max_iter=50)
    assert models.fit_parts(models.FOREST, 240, config) == [config]
    monkeypatch.setattr(models, "TREE_ROWS", 240 * 4)
    monkeypatch.setattr(models, "TASK_ROWS", 30)
    parts = models.fit_parts(models.FOREST, 240, config)
    assert sum(p.trees for p in parts) == 11 and max(p.trees for p in parts) <= 4
    assert len({p.seed for p in parts}) == len(parts) == 3
    assert models.fit_parts(models.LOGISTIC, 10**9, config) == [config]
    fitted = list(models.fit_all(models.FOREST, features, config))
    assert [m.getNumTrees for m in fitted] == [p.trees for p in parts]
    rows = models.feature_importance(models.FOREST, iter(fitted), features, columns).collect()
    assert rows[0].feature == "E2" and abs(sum(r.importance for r in rows) - 1) < 1e-9
    summary = train(spark, features, columns, str(tmp_path / "model"), folds=3, config=config)
    assert {r.model: r.mean_auc > 0.9 for r in summary.collect()}[models.FOREST]
    scores = spark.read.parquet(f"{tmp_path}/model/scores").filter(f"model = '{models.FOREST}'").collect()
    assert len(scores) == 240 and all(0 <= r.score <= 1 and r.prediction == (r.score > 0.5) for r in scores)


def test_deep_trees_stay_at_the_driver():
    """Their nodes are cached per row; the trees themselves are not sent with every task."""
    assert models.estimator(models.FOREST, 10).getCacheNodeIds()
