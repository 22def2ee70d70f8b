"""Select features, cross-validate, pick and fit the best classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.counts import matrix_columns, unpivot_matrix
from logloom.operators.folds import stratified_folds
from logloom.operators.labels import require_both_classes
from logloom.operators.metrics import best_model, cv_results, cv_summary
from logloom.operators.models import MODELS, ModelConfig, cross_validate, feature_importance, fit_all
from logloom.operators.selection import select_features, sparse_feature_table
from logloom.session import stage


def features_of(
    counts: DataFrame,
    labels: DataFrame,
    positive: str = "Anomaly",
    variance: float | None = 0.01,
    correlation: float | None = 0.95,
    events: DataFrame | None = None,
) -> tuple[DataFrame, list[str]]:
    """Feature table (entity_id, features, target) and the events behind the vector slots.

    ``counts`` has one row per entity and event. The table is staged; its vectors are sparse, so the number of events is
    not limited by that of columns.
    """
    if variance is None and correlation is None and events is not None:
        kept = events
    else:
        kept = select_features(counts, variance, correlation, events)
    columns = matrix_columns(kept.select(F.col("event_id").alias("EventId")))
    return sparse_feature_table(counts, columns, labels, positive), columns


def train(
    spark: SparkSession,
    features: DataFrame,
    columns: list[str],
    out: str,
    folds: int = 10,
    config: ModelConfig = ModelConfig(),
) -> DataFrame:
    """Write features, held-out scores, per-fold results, summary, model and importances."""
    require_both_classes(features)
    features.write.mode("overwrite").parquet(f"{out}/features")
    scores = cross_validate(stratified_folds(features, folds, config.seed), MODELS, config)
    scores.write.mode("overwrite").parquet(f"{out}/scores")
    results = stage(cv_results(scores), "results")
    results.write.mode("overwrite").parquet(f"{out}/results")
    summary = stage(cv_summary(results), "summary")
    summary.write.mode("overwrite").parquet(f"{out}/summary")
    winner = best_model(summary, list(MODELS)).first()["model"]

    def saved() -> Iterator:
        """The model's parts, one folder each; nearly always there is one."""
        for i, model in enumerate(fit_all(winner, features, config)):
            model.write().overwrite().save(f"{out}/model-{winner.lower().replace(' ', '_')}" + (f"-{i + 1}" if i else ""))
            yield model

    importance = feature_importance(winner, saved(), features, columns)
    importance.write.mode("overwrite").parquet(f"{out}/importance")
    return summary


def counts_of_matrix(matrix: DataFrame) -> DataFrame:
    """Long counts of a matrix read from elsewhere."""
    return unpivot_matrix(matrix)
