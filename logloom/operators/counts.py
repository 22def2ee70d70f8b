"""Event counts per entity: long form first, wide matrix for export and model input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.text import event_number
from logloom.session import broadcast_if_small


def entity_event_counts(events: DataFrame, entity_col: str) -> DataFrame:
    """(entity_id, event_id, n) over events that name an entity.

    A plain count: each task sends at most one row per entity and event, so an entity that
    holds a third of all lines is no heavier than the others after the first step.
    """
    return (
        events.filter(F.col(entity_col).isNotNull())
        .groupBy(F.col(entity_col).alias("entity_id"), F.col("EventId").alias("event_id"))
        .agg(F.count("*").alias("n"))
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """Sum partial counts of the same entity and event."""
    return counts.groupBy("entity_id", "event_id").agg(F.sum("n").alias("n"))


def event_columns(columns: list[str]) -> list[str]:
    """The event columns among ``columns``: ``E`` and digits, in numeric order."""
    return sorted((c for c in columns if c[:1] == "E" and c[1:].isdecimal()), key=lambda c: int(c[1:]))


def matrix_columns(templates: DataFrame) -> list[str]:
    """Event ids of a template table as matrix columns: the header of a matrix, one name per event."""
    return event_columns([row[0] for row in templates.select("EventId").collect()])


def pivot_limit(spark: SparkSession) -> int:
    """So many events become columns of a table; beyond that a matrix has one array of cells per entity."""
    return int(spark.conf.get("spark.sql.pivotMaxValues"))


def entity_cells(counts: DataFrame, columns: list[str]) -> DataFrame:
    """(entity_id, cells): the counts of an entity as (slot, n) by slot, its place among ``columns``.

    Events outside ``columns`` are left out, their entities stay. A list is as long as the distinct events of the entity.
    """
    places = [(name, slot) for slot, name in enumerate(columns)]
    slots = counts.sparkSession.createDataFrame(places, "event_id string, slot int")
    cell = F.when(F.col("slot").isNotNull(), F.struct("slot", F.col("n").cast("bigint").alias("n")))
    placed = counts.join(broadcast_if_small(slots), "event_id", "left")
    return placed.groupBy("entity_id").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def dense(cells: Column, width: int) -> Column:
    """All ``width`` counts of an entity, zeros included: every cell behind the zeros before it."""

    def run(cell: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(cells, i - 1)["slot"])
        return F.concat(F.array_repeat(F.lit(0).cast("bigint"), cell["slot"] - before - 1), F.array(cell["n"]))

    last = F.coalesce(F.get(cells, F.size(cells) - 1)["slot"], F.lit(-1))
    tail = F.array_repeat(F.lit(0).cast("bigint"), F.lit(width - 1) - last)
    return F.concat(F.flatten(F.transform(cells, run)), tail)


def cell_matrix(counts: DataFrame, columns: list[str]) -> DataFrame:
    """The occurrence matrix at any width: entity_id, cells (one zero-filled array), total_events."""
    found = entity_cells(counts, columns)
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda sum_, cell: sum_ + cell["n"])
    return found.select("entity_id", dense(F.col("cells"), len(columns)).alias("cells"), total.alias("total_events"))


def occurrence_matrix(counts: DataFrame, columns: list[str]) -> DataFrame:
    """One row per entity, one zero-filled column per event id, in the given order.

    Events outside ``columns`` are left out, their entities stay.
    """
    wide = counts.groupBy("entity_id").pivot("event_id", columns).agg(F.sum("n"))
    return wide.na.fill(0, subset=columns)


def dropped_events(counts: DataFrame, columns: list[str]) -> DataFrame:
    """Lines per event that a matrix over ``columns`` leaves out."""
    return counts.filter(~F.col("event_id").isin(columns)).groupBy("event_id").agg(F.sum("n").alias("n"))


def with_total(matrix: DataFrame) -> DataFrame:
    """Add ``total_events``, the sum over the event columns."""
    total = F.lit(0).cast("bigint")
    for name in event_columns(matrix.columns):
        total = total + F.col(name)
    return matrix.withColumn("total_events", total)


def unpivot_matrix(matrix: DataFrame) -> DataFrame:
    """Long form of a wide matrix; zero cells are left out."""
    columns = event_columns(matrix.columns)
    return matrix.unpivot("entity_id", columns, "event_id", "n").filter("n > 0")


def entity_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("entity_id").agg(F.sum("n").alias("total_events"))


def entity_count(counts: DataFrame) -> DataFrame:
    """One row: number of entities."""
    return counts.agg(F.count_distinct("entity_id").alias("entities"))


def matrix_density(counts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Entities, events, nonzero cells and their share of all cells in percent.

    ``events`` (event_id) are the matrix columns; by default the events that occur.
    """
    entities = entity_count(counts).scalar()
    if events is None:
        cells = counts
        width = counts.agg(F.count_distinct("event_id")).scalar()
    else:
        # Counts have few events for their rows: dealt by event, one task would sort an event's rows.
        cells = counts.join(broadcast_if_small(events.select("event_id").distinct()), "event_id", "left_semi")
        width = events.agg(F.count_distinct("event_id")).scalar()
    sized = cells.agg(F.count("*").alias("nonzero")).select(entities.alias("entities"), width.alias("events"), "nonzero")
    share = F.try_divide(F.col("nonzero") * 100.0, F.col("entities") * F.col("events"))
    return sized.withColumn("density_pct", share)


def total_summary(totals: DataFrame) -> DataFrame:
    """Mean, min, max and exact median of ``total_events``.

    The median reads a histogram of the distinct totals. Distinct totals add up to at most the
    number of lines, so there are fewer than the square root of twice that number.
    """
    histogram = totals.groupBy("total_events").agg(F.count("*").alias("entities"))
    value = F.col("total_events")
    return histogram.agg(
        F.sum("entities").alias("entities"),
        (F.sum(value.cast("decimal(38,0)") * F.col("entities")).cast("double") / F.sum("entities")).alias("mean_events"),
        F.min(value).alias("min_events"),
        F.max(value).alias("max_events"),
        F.percentile(value, 0.5, F.col("entities")).alias("median_events"),
    )


def events_of(templates: DataFrame) -> DataFrame:
    """(event_id, event_no) of a template table."""
    return templates.select(F.col("EventId").alias("event_id")).withColumn("event_no", event_number(F.col("event_id")))
