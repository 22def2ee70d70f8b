"""Classifiers, cross-validation and importances on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from logloom.operators import forests
from logloom.session import drop_path, stage, stage_at

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
MODELS = (LOGISTIC, FOREST)

# Rows times trees that one fit grows, and all that run side by side: the driver holds the nodes of
# a fit, and a tree has at most twice its rows.
TREE_ROWS, SIDE_ROWS = 2_500_000, 7_500_000
# Rows times trees up to which Spark grows the forests of a cross-validation, as it takes little time then.
SMALL_TREE_ROWS = 100_000
# Rows of a task of the final fit; a table that is read by fewer tasks is dealt to more.
TASK_ROWS = 50_000


@dataclass(frozen=True)
class ModelConfig:
    """One configuration for cross-validation and the final fit."""

    seed: int = 42
    max_iter: int = 1000
    inverse_penalty: float = 1.0
    trees: int = 100
    max_depth: int = 30


def estimator(name: str, rows: int, config: ModelConfig = ModelConfig()):
    """Unfitted classifier. ``rows`` scales the penalty, which Spark averages over rows."""
    columns = {"featuresCol": "features", "labelCol": "target"}
    if name == LOGISTIC:
        penalty = 1.0 / (config.inverse_penalty * rows)
        return LogisticRegression(
            maxIter=config.max_iter, regParam=penalty, elasticNetParam=0.0, standardization=False, **columns
        )
    if name == FOREST:
        return RandomForestClassifier(
            numTrees=config.trees, maxDepth=config.max_depth, featureSubsetStrategy="sqrt", seed=config.seed,
            # Deep trees are not sent to the tasks at every level; the trees are the same.
            cacheNodeIds=True, **columns,
        )
    raise ValueError(f"unknown model {name!r}")


def fit_parts(name: str, rows: int, config: ModelConfig = ModelConfig()) -> list[ModelConfig]:
    """Configurations of the fits that make up a model of ``rows`` rows.

    A forest of many rows grows in smaller forests, each with a seed of its own, so that the driver never
    holds more than one part's nodes: the votes and importances of a forest are sums over its trees.
    """
    if name != FOREST:
        return [config]
    parts = min(math.ceil(config.trees * rows / TREE_ROWS), math.ceil(config.trees / 2)) or 1
    sizes = [config.trees * (i + 1) // parts - config.trees * i // parts for i in range(parts)]
    return [replace(config, trees=size, seed=config.seed + i) for i, size in enumerate(sizes)]


def score(model, rows: DataFrame) -> DataFrame:
    """(entity_id, target, prediction, score), the score being the probability of class 1."""
    return model.transform(rows).select(
        "entity_id",
        "target",
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def _scored_in_parts(train: DataFrame, held_out: DataFrame, rows: int, parts: list[ModelConfig]) -> DataFrame:
    """``score`` of a forest that grows in parts; each adds its trees' votes to the rows and is let go."""
    voted = held_out.select("entity_id", "target", "features", F.lit(0.0).alias("no"), F.lit(0.0).alias("yes"))
    path = None
    for part in parts:
        model = estimator(FOREST, rows, part).fit(train)
        votes = vector_to_array("rawPrediction")
        added = model.transform(voted).select(
            "entity_id", "target", "features", (F.col("no") + votes[0]).alias("no"), (F.col("yes") + votes[1]).alias("yes")
        )
        last = path
        voted, path = stage_at(added, "votes")
        if last is not None:
            drop_path(train.sparkSession, last)
    prediction = (F.col("yes") > F.col("no")).cast("int")
    share = F.col("yes") / (F.col("no") + F.col("yes"))
    return voted.select("entity_id", "target", prediction.alias("prediction"), share.alias("score"))


def cross_validate(
    folded: DataFrame, names: tuple[str, ...] = MODELS, config: ModelConfig = ModelConfig(), parallel: int = 8
) -> DataFrame:
    """Held-out scores (model, fold, entity_id, target, prediction, score) of every fold.

    ``folded``: entity_id, features, target, fold. The table is staged once, partitioned by
    fold, so a fit reads only its training folds and a scoring only its own. Fits run on the
    cluster; the driver keeps ``parallel`` of them going, fewer when their trees are large. Forests over a table
    that a task can hold are grown by tasks, all folds in one job (``forests``), but for small ones.
    """
    table = stage(folded, "folded", partition_by=("fold",))
    target = F.col("target")
    facts = table.groupBy("fold").agg(
        F.count("*").alias("rows"), F.count_if(target == 1).alias("hits"), F.count_if(target.isin(0, 1)).alias("known"),
        F.max(F.size(vector_to_array("features"))).alias("width"),
    ).collect()
    sizes = {row["fold"]: row["rows"] for row in facts}
    rows = sum(sizes.values())
    hits = sum(row["hits"] for row in facts)
    # What Spark's fit refuses, it goes on refusing: a fold whose training rows hold no positive.
    grown = FOREST in names and all(row["known"] == row["rows"] and row["hits"] < hits for row in facts)
    grown = grown and rows * config.trees > SMALL_TREE_ROWS
    grown = grown and forests.fits(rows, max((row["width"] for row in facts), default=0))

    def run(job: tuple[str, int]) -> DataFrame:
        name, fold = job
        train = table.filter(F.col("fold") != fold)
        held_out = table.filter(F.col("fold") == fold)
        size = rows - sizes[fold]
        if name == LOGISTIC:
            # Every step of the fit is a job over these partitions, and the folds are many small files.
            train = train.coalesce(max(1, math.ceil(size / TASK_ROWS)))
        parts = fit_parts(name, size, config)
        if len(parts) == 1:
            held_out = score(estimator(name, size, config).fit(train), held_out)
        else:
            held_out = _scored_in_parts(train, held_out, size, parts)
        # Written here, so that a fold's model is not kept until all are fitted.
        return stage(held_out.select(F.lit(name).alias("model"), F.lit(fold).alias("fold"), "*"), "held-out")

    jobs = [(name, fold) for fold in sorted(sizes) for name in names if not (grown and name == FOREST)]
    in_cluster = FOREST in names and not grown
    largest = max((part.trees for part in fit_parts(FOREST, rows, config)), default=0) * rows if in_cluster else 0
    side = max(1, min(parallel, SIDE_ROWS // max(1, largest)))
    if not in_cluster:
        # The steps of a logistic fit are short jobs; more fits than this only add to what the driver holds.
        side = min(side, max(1, table.sparkSession.sparkContext.defaultParallelism // 2))
    with ThreadPoolExecutor(side) as pool:
        parts = list(pool.map(inheritable_thread_target(table.sparkSession)(run), jobs))
    if grown:
        held_out = forests.fold_scores(table, sizes, facts[0]["width"], config.trees, config.max_depth, config.seed)
        parts.append(held_out.select(F.lit(FOREST).alias("model"), "*"))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return stage(scores, "scores")


def fit_final(name: str, features: DataFrame, config: ModelConfig = ModelConfig()):
    """Fit the chosen model on all rows."""
    return estimator(name, features.count(), config).fit(features)


def fit_all(name: str, features: DataFrame, config: ModelConfig = ModelConfig()) -> Iterator:
    """The models of ``fit_parts`` on all rows, one after the other; a single one unless a forest is large."""
    rows = features.count()
    table = dealt(features, rows)
    for part in fit_parts(name, rows, config):
        yield fit_final(name, table, part)


def dealt(features: DataFrame, rows: int) -> DataFrame:
    """``features`` in at least a partition per ``TASK_ROWS`` rows: narrow rows of many entities are read by few tasks."""
    least = math.ceil(rows / TASK_ROWS)
    return features.repartition(least) if least > features.rdd.getNumPartitions() else features


def _weights(name: str, model, features: DataFrame):
    if name == FOREST:
        # A model's importances are the mean over its trees that split.
        return model.featureImportances.toArray() * sum(tree.numNodes > 1 for tree in model.trees)
    spread = features.select(Summarizer.std(F.col("features")).alias("std")).first()["std"]
    return abs(model.coefficients.toArray() * spread.toArray())


def feature_importance(name: str, model, features: DataFrame, columns: list[str], k: int = 15) -> DataFrame:
    """The ``k`` most important features, best first by ``rank``.

    Forest: impurity importances. Logistic regression: absolute coefficient times the standard
    deviation of the feature. Both are as long as the feature vector, a driver-side list. ``model`` is one model or those
    of ``fit_parts`` one after the other; only their weights are kept.
    """
    if not isinstance(model, Iterable):
        weights = model.featureImportances.toArray() if name == FOREST else _weights(name, model, features)
    else:
        weights = sum(_weights(name, part, features) for part in model)
        if name == FOREST and weights.sum() > 0:
            weights = weights / weights.sum()
    ranked = sorted(zip(columns, weights), key=lambda pair: -pair[1])[:k]
    rows = [(i, feature, float(weight)) for i, (feature, weight) in enumerate(ranked, 1)]
    return features.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")
