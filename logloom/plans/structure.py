"""From lines to structured events with one template dictionary over all sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.formats import LogFormat, Mask, MiningConfig
from logloom.functions.text import signature
from logloom.operators.parse import parse_lines
from logloom.operators.templates import (
    assign_events,
    exact_templates,
    mine,
    occurrences,
    signature_counts,
    template_table,
)
from logloom.session import broadcast_if_small, stage
from logloom.sources.lines import clean_lines, order_key


@dataclass(frozen=True)
class Structured:
    """Events (source, LineId, header fields, entity, EventId, EventTemplate, is_parsed) and
    templates (EventId, EventTemplate, Occurrences); ``dictionary`` is None in exact mode."""

    events: DataFrame
    templates: DataFrame
    dictionary: DataFrame | None = None


def signed_events(lines: DataFrame, fmt: LogFormat, masks: tuple[Mask, ...] | None = None) -> DataFrame:
    """Parsed events with ``signature`` and ``seen_at``."""
    ordered = lines.withColumn("seen_at", order_key(lines))
    events = parse_lines(clean_lines(ordered), fmt)
    return events.withColumn("signature", signature(F.col("Content"), fmt.masks if masks is None else masks))


def structure(
    lines: DataFrame,
    fmt: LogFormat,
    mining: MiningConfig | None = None,
    known: DataFrame | None = None,
    masks: tuple[Mask, ...] | None = None,
) -> Structured:
    """Parse lines and give every line its event.

    Without ``mining`` each signature is a template; with it similar signatures share one, and
    a ``known`` dictionary keeps its ids. The parsed lines are staged: the regexes run once,
    and mining reads back two columns.
    """
    parsed = stage(signed_events(lines, fmt, masks), "parsed")
    signatures = stage(signature_counts(parsed), "signatures")
    if mining is None:
        templates = stage(exact_templates(signatures), "templates")
        lookup = templates.select("signature", "EventId", "EventTemplate")
        events = parsed.join(broadcast_if_small(lookup), "signature", "left")
        return Structured(events, templates.select("event_no", "EventId", "EventTemplate", "Occurrences"))
    dictionary, assignment = mine(signatures, mining, known)
    templates = template_table(dictionary, occurrences(signatures, assignment))
    return Structured(assign_events(parsed, assignment, dictionary), templates, dictionary)
