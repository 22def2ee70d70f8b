"""Entity labels: label tables, label precedence over several sources, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.text import is_positive
from logloom.session import broadcast_if_small

# Instances with injected anomalies of the public VM log data set.
ANOMALY_INSTANCES = (
    "544fd51c-4edc-4780-baae-ba1d80a0acfc",
    "ae651dff-c7ad-43d6-ac96-bbcd820ccca8",
    "a445709b-6ad0-40ec-8860-bec60b6ca0c2",
    "1643649d-2f42-4303-bfcd-7798baec19f9",
)


def anomaly_instances(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ANOMALY_INSTANCES], "entity_id string")


def join_labels(matrix: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Left join of labels (entity_id, label); without a label table the matrix is returned."""
    return matrix if labels is None else matrix.join(labels, "entity_id", "left")


def label_sources(lines: DataFrame, source_labels: DataFrame) -> DataFrame:
    """Tag rows with the label of their source (source, source_order, source_label).

    One scan over all files instead of a union of scans; files that are absent add nothing.
    """
    return lines.join(broadcast_if_small(source_labels), "source")


def label_by_precedence(tagged: DataFrame, entity_col: str, anomalies: DataFrame) -> DataFrame:
    """(entity_id, label): Anomaly for listed ids, else the label of the first source seen."""
    seen = (
        tagged.filter(F.col(entity_col).isNotNull())
        .groupBy(F.col(entity_col).alias("entity_id"))
        .agg(F.min_by("source_label", "source_order").alias("source_label"))
    )
    listed = anomalies.select("entity_id", F.lit("Anomaly").alias("listed")).distinct()
    return seen.join(broadcast_if_small(listed), "entity_id", "left").select(
        "entity_id", F.coalesce("listed", "source_label").alias("label")
    )


def label_or_default(entities: DataFrame, labels: DataFrame, default: str = "Unknown") -> DataFrame:
    """Every entity with its label, ``default`` where it has none."""
    return entities.join(labels, "entity_id", "left").withColumn("label", F.coalesce("label", F.lit(default)))


def binary_target(labelled: DataFrame, positive: str, drop_unlabelled: bool = False) -> DataFrame:
    """Add ``target`` 0/1. Unlabelled rows count as 0 unless dropped."""
    rows = labelled.filter(F.col("label").isNotNull()) if drop_unlabelled else labelled
    return rows.withColumn("target", is_positive(F.col("label"), positive))


def require_both_classes(features: DataFrame, target: str = "target") -> None:
    """Raise when one class is empty, e.g. because of a wrong positive label."""
    ones, rows = features.agg(F.coalesce(F.sum(target), F.lit(0)), F.count("*")).first()
    if not 0 < ones < rows:
        raise ValueError(f"need both classes, got {ones} positive of {rows} rows")
