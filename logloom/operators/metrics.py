"""Exact classification metrics from a score table (target, prediction, score).

``by`` names grouping columns such as model and fold. The area under the curve and the curve
itself first merge equal scores, so ties share a rank, and then use running totals over score
ranges; there is no window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from logloom.operators.ranking import running_totals, with_range
from logloom.session import stage


def _counts() -> dict:
    hit, said = F.col("target") == 1, F.col("prediction") == 1
    return {
        "tn": F.count_if(~hit & ~said),
        "fp": F.count_if(~hit & said),
        "fn": F.count_if(hit & ~said),
        "tp": F.count_if(hit & said),
    }


def confusion_matrix(scores: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """tn, fp, fn, tp in one row per group."""
    return scores.groupBy(*by).agg(*[c.alias(name) for name, c in _counts().items()])


def precision_recall(scores: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall and F1; 0 where undefined."""
    cells = confusion_matrix(scores, by)
    tp = F.col("tp").cast("double")

    def ratio(below) -> F.Column:
        return F.coalesce(F.try_divide(tp, below), F.lit(0.0))

    return cells.select(
        *by,
        ratio(F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp") + F.col("fn")).alias("recall"),
        ratio(F.col("tp") + (F.col("fp") + F.col("fn")) / 2).alias("f1"),
    )


def _by_score(scores: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scores.groupBy(*by, "score").agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") == 0).alias("neg")
    )


def roc_auc(scores: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve; a tie counts one half, NULL when a class is empty."""
    ranked = running_totals(stage(_by_score(scores, by), "points"), "score", {"neg_below": "neg"}, by)
    # Twice the number of ordered pairs, as an exact integer.
    won = (F.col("pos").cast("decimal(18,0)") * (2 * F.col("neg_below") + F.col("neg"))).cast("decimal(38,0)")
    pairs = F.sum("pos").cast("double") * F.sum("neg") * 2
    return ranked.groupBy(*by).agg(F.try_divide(F.sum(won).cast("double"), pairs).alias("auc"))


def roc_curve(scores: DataFrame, by: tuple[str, ...] = (), drop_intermediate: bool = True) -> DataFrame:
    """Points (threshold, fpr, tpr), the origin with an infinite threshold included.

    With ``drop_intermediate`` a point between two equal steps is left out, as it lies on the
    line through its neighbours; the first and the last point stay.
    """
    points = stage(_by_score(scores, by).withColumn("desc", -F.col("score")), "points")
    ranked = running_totals(points, "desc", {"neg_before": "neg", "pos_before": "pos"}, by)
    sizes = points.groupBy(*by).agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.min("desc").alias("first"), F.max("desc").alias("last")
    )
    if drop_intermediate:
        # The step after a point: within its range by a window, else the first one of the next
        # range that holds any.
        ranged, _ = with_range(stage(ranked, "curve"), "desc")
        step = F.struct("pos", "neg")
        heads = ranged.groupBy(*by, "range_no").agg(F.min_by(step, "desc").alias("head"))
        following = F.lead("head").over(W.partitionBy(*by).orderBy("range_no"))
        heads = heads.select(*by, "range_no", following.alias("next_head"))
        inside = F.lead(step).over(W.partitionBy(*by, "range_no").orderBy("desc"))
        ranked = ranged.withColumn("inside", inside).join(heads, [*by, "range_no"])
        ranked = ranked.withColumn("next", F.coalesce("inside", "next_head"))
    joined = ranked.join(sizes, list(by)) if by else ranked.join(F.broadcast(sizes))
    if drop_intermediate:
        bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        joined = joined.filter((F.col("desc") == F.col("first")) | (F.col("desc") == F.col("last")) | bend)
    curve = joined.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide((F.col("neg_before") + F.col("neg")).cast("double"), F.col("n")).alias("fpr"),
        F.try_divide((F.col("pos_before") + F.col("pos")).cast("double"), F.col("p")).alias("tpr"),
    )
    origin = sizes.select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def cv_results(scores: DataFrame) -> DataFrame:
    """Precision, recall, F1 and AUC per model and fold."""
    by = ("model", "fold")
    return precision_recall(scores, by).join(roc_auc(scores, by), list(by))


def cv_summary(results: DataFrame) -> DataFrame:
    """Mean and population standard deviation of each metric per model."""
    metrics = ("precision", "recall", "auc")
    return results.groupBy("model").agg(
        F.count("*").alias("folds"),
        *[F.avg(m).alias(f"mean_{m}") for m in metrics],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in metrics],
    )


def best_model(summary: DataFrame, order: list[str]) -> DataFrame:
    """The model with the highest mean AUC; the first in ``order`` on ties."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("model"))
    key = F.struct("mean_auc", (-place).alias("place"))
    return summary.agg(F.max_by("model", key).alias("model"), F.max("mean_auc").alias("mean_auc"))
