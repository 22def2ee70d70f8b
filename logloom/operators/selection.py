"""Feature selection on the long form, and the feature table."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.operators.counts import entity_cells, event_columns
from logloom.operators.labels import binary_target, join_labels
from logloom.operators.profile import event_variance, strong_correlations
from logloom.session import stage_at


def select_by_variance(counts: DataFrame, threshold: float = 0.01, events: DataFrame | None = None) -> DataFrame:
    """Events (event_id, event_no) that stay: all but those with variance below the threshold.

    A single entity has no variance, and then nothing is dropped.
    """
    keep = F.col("variance").isNull() | (F.col("variance") >= threshold)
    return event_variance(counts, events).filter(keep).select("event_id", "event_no")


def correlated_events(correlation: DataFrame, limit: float = 0.95) -> DataFrame:
    """Events with ``abs(r) > limit`` to any earlier event, dropped ones included."""
    return correlation.filter(F.abs("r") > limit).select(F.col("event_b").alias("event_id")).distinct()


def select_by_correlation(counts: DataFrame, events: DataFrame, limit: float = 0.95) -> DataFrame:
    """Events (event_id, event_no) of ``events`` that stay."""
    drop = correlated_events(strong_correlations(counts, limit, events), limit)
    return events.join(drop, "event_id", "left_anti").select("event_id", "event_no")


def select_features(counts: DataFrame, variance: float | None = 0.01, correlation: float | None = 0.95, events: DataFrame | None = None) -> DataFrame:
    """Both selections in order; ``None`` switches one off."""
    kept = select_by_variance(counts, float("-inf") if variance is None else variance, events)
    return kept if correlation is None else select_by_correlation(counts, kept, correlation)


def feature_table(matrix: DataFrame) -> DataFrame:
    """Wide labelled matrix (entity_id, E.., target) to (entity_id, features, target).

    The assembler picks the sparse form where it is smaller. Missing counts become zero.
    """
    columns = event_columns(matrix.columns)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    return assembler.transform(matrix.na.fill(0, subset=columns)).select("entity_id", "features", "target")


def sparse_feature_table(counts: DataFrame, columns: list[str], labels: DataFrame | None, positive: str) -> DataFrame:
    """(entity_id, features, target) straight from long counts: one sparse vector per entity, no pivot.

    A vector is written as the struct that it is stored as and read back as a vector, so it is never
    built row by row; the table is staged by that.
    """
    labelled = binary_target(join_labels(entity_cells(counts, columns), labels), positive)
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(len(columns)).alias("size"),
        F.transform("cells", lambda cell: cell["slot"]).alias("indices"),
        F.transform("cells", lambda cell: cell["n"].cast("double")).alias("values"),
    )
    table = labelled.select("entity_id", parts.alias("features"), "target")
    _, path = stage_at(table, "features")
    kinds = [T.StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in table.schema]
    return table.sparkSession.read.schema(T.StructType(kinds)).parquet(path)


def feature_summary(features: DataFrame) -> DataFrame:
    """Rows and class sizes of a feature table."""
    return features.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("target") == 0).alias("negatives"),
        F.count_if(F.col("target") == 1).alias("positives"),
    )
