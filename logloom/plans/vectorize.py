"""Counts and labelled matrices from structured events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logloom.functions.formats import LogFormat
from logloom.operators.counts import entity_event_counts, occurrence_matrix, with_total
from logloom.operators.labels import join_labels, label_by_precedence, label_sources


def block_matrix(counts: DataFrame, columns: list[str], labels: DataFrame | None) -> DataFrame:
    """entity_id, one column per event, total_events, label (if there are labels)."""
    return join_labels(with_total(occurrence_matrix(counts, columns)), labels)


def vm_matrix(
    events: DataFrame, fmt: LogFormat, columns: list[str], source_labels: DataFrame, anomalies: DataFrame
) -> DataFrame:
    """Matrix over the labelled sources; a listed id is an anomaly, else its first source decides."""
    tagged = label_sources(events, source_labels)
    labels = label_by_precedence(tagged, fmt.entity_col, anomalies)
    counts = entity_event_counts(tagged, fmt.entity_col)
    return join_labels(with_total(occurrence_matrix(counts, columns)), labels)
