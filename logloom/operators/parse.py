"""Header parse, fallback rows and entity extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.formats import LogFormat
from logloom.functions.text import all_entities, first_entity, header_groups


def parse_lines(lines: DataFrame, fmt: LogFormat) -> DataFrame:
    """Cleaned lines to events: header fields, entity column, ``is_parsed``.

    A line that does not match keeps empty header fields, its whole text as content, and the
    entity found in it. Other columns of ``lines`` (source, LineId, ...) pass through.
    """
    passed = [c for c in lines.columns if c != "value"]
    width = len(fmt.fields) + 1
    # The group array is a column of its own, so the regex runs once for all the fields.
    grouped = lines.withColumn("groups", header_groups(F.col("value"), fmt))
    matched = F.size("groups") == width
    fields = [
        F.when(matched, F.get("groups", F.lit(i))).otherwise(F.col("value") if name == "Content" else F.lit("")).alias(name)
        for i, name in enumerate(fmt.fields, 1)
    ]
    # As generator output the fields stay columns: a filter on one of them is not rewritten into
    # a predicate that repeats the whole parse below it.
    row = F.struct(matched.alias("is_parsed"), *fields)
    events = grouped.select(*passed, F.inline(F.array(row)))
    return events.withColumn(fmt.entity_col, first_entity(F.col("Content"), fmt))


def explode_entities(events: DataFrame, fmt: LogFormat) -> DataFrame:
    """One row per entity named in the content, in place of the first one only."""
    return events.withColumn(fmt.entity_col, F.explode_outer(all_entities(F.col("Content"), fmt)))


def structured(events: DataFrame, fmt: LogFormat) -> DataFrame:
    """The structured event table: source first, then the fixed column order of the family."""
    return events.select("source", *fmt.columns)
