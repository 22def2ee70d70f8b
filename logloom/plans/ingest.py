"""Incremental ingest: read the files that are new or changed, once, and remember them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.formats import LogFormat, Mask, MiningConfig
from logloom.operators.parse import structured
from logloom.operators.templates import current_dictionary
from logloom.plans.structure import structure
from logloom.session import broadcast_if_small, stage
from logloom.sources.ledger import latest, plan_ingest, read_ledger, record, unchanged
from logloom.sources.lines import TextSource, list_files
from logloom.sources.tables import drop_sources, read_events, read_or_none, write_events


def ingest(
    spark: SparkSession,
    fmt: LogFormat,
    raw: str,
    out: str,
    sources: list[str] | None = None,
    mining: MiningConfig = MiningConfig(),
    archive: str | None = None,
    masks: tuple[Mask, ...] | None = None,
) -> DataFrame:
    """Bring ``out`` (events, dictionary, ledger) up to date with the files below ``raw``.

    Returns the decision per source. A file of the length and time of its last ingest is not read at all;
    the others are read once for their fingerprint, and new or changed ones a second time. Safe to run again after a failure at any point: events
    are replaced per source, known templates keep their ids, the ledger is written after the
    events, and whatever it holds and is still in ``raw`` is archived, now or by the next run. A file of no bytes counts as absent.
    """
    listed = list_files(spark, raw)
    if sources is not None:
        listed = listed.join(broadcast_if_small(spark.createDataFrame([(s,) for s in sources], "source string")), "source", "left_semi")
    listed = stage(listed, "listed")
    known = stage(latest(read_ledger(spark, f"{out}/ledger")), "known")
    quiet = stage(unchanged(listed, known), "unchanged")
    # File names only, as any listing brings them to the driver.
    to_read = {row["source"] for row in listed.join(quiet, "source", "left_anti").select("source").toLocalIterator()}

    def files_of(names: set[str]) -> TextSource:
        if sources is None and len(names) == listed.count():
            return TextSource(spark, raw)
        order = sources or [row["source"] for row in listed.select("source").orderBy("source").toLocalIterator()]
        return TextSource(spark, raw, sources=[name for name in order if name in names])

    present, files = quiet, None
    if to_read:
        files = files_of(to_read)
        present = quiet.unionByName(files.fingerprints().select("source", "fingerprint"))
    present = stage(present, "present")
    wanted = present.select("source")
    if sources is not None:
        wanted = spark.createDataFrame([(s,) for s in sources], "source string")
    plan = stage(plan_ingest(wanted, present, known), "plan")
    todo = plan.filter(F.col("decision").isin("parse", "reparse")).select("source", "fingerprint")
    done = plan.filter(F.col("decision").isin("parse", "reparse", "skip")).select("source")
    # Read again and found the same: from now on known by their new time.
    touched = plan.filter("decision = 'skip'").join(quiet, "source", "left_anti").join(listed, "source")
    if not touched.isEmpty():
        record(touched.withColumns({"num_lines": F.col("known_lines"), "num_templates": F.col("known_templates")}), f"{out}/ledger")
    names = {row["source"] for row in todo.select("source").toLocalIterator()}
    if not names:
        if archive is not None:
            archive_files(spark, raw, archive, done)
        return plan
    if names != to_read:
        files = files_of(names)
    dictionary = read_or_none(spark, f"{out}/dictionary")
    if dictionary is not None:
        # Staged once: mining reads it many times, and the table it comes from grows below.
        dictionary = stage(current_dictionary(dictionary), "dictionary")
    result = structure(files.lines(), fmt, mining, dictionary, masks)
    new = result.dictionary
    if dictionary is not None:
        new = new.join(dictionary, ["event_no", "EventTemplate"], "left_anti")
    # The dictionary only grows (a changed text is a further row of its event), so a run that
    # stops after this line loses nothing.
    new.write.mode("append").parquet(f"{out}/dictionary")
    write_events(structured(result.events, fmt), f"{out}/events")
    # What is left without a line that is not blank has no rows to replace the old ones.
    drop_sources(spark, f"{out}/events", todo.join(result.events.select("source").distinct(), "source", "left_anti"))
    sizes = read_events(spark, f"{out}/events").join(broadcast_if_small(todo), "source").groupBy("source", "fingerprint").agg(
        F.count("*").alias("num_lines"), F.count_distinct("EventId").alias("num_templates")
    )
    # A source without events is known as well.
    sizes = todo.join(sizes.drop("fingerprint"), "source", "left").na.fill(0, subset=["num_lines", "num_templates"])
    record(sizes.join(listed, "source"), f"{out}/ledger")
    if archive is not None:
        archive_files(spark, raw, archive, done)
    return plan


def templates(spark: SparkSession, out: str) -> DataFrame:
    """EventId, EventTemplate and the lines of each event over all that was ingested."""
    lines = read_events(spark, f"{out}/events").groupBy("EventId").agg(F.count("*").alias("Occurrences"))
    dictionary = current_dictionary(spark.read.parquet(f"{out}/dictionary")).select("event_no", "EventId", "EventTemplate")
    return dictionary.join(lines, "EventId", "left").na.fill(0, subset=["Occurrences"])


def archive_files(spark: SparkSession, raw: str, archive: str, sources: DataFrame, movers: int = 16) -> None:
    """Move the files of ``sources`` out of ``raw``; the new name carries the time of the move.

    Names come in one by one and several files move at a time. A file that is gone already was
    moved by an earlier run.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(archive)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")

    def move(name: str) -> None:
        here, moved = path(f"{raw.rstrip('/')}/{name}"), path(target, f"{name}_{stamp}")
        if not fs.exists(here):
            return
        fs.mkdirs(moved.getParent())
        if not fs.rename(here, moved):
            raise OSError(f"could not archive {name}")

    with ThreadPoolExecutor(movers) as pool:
        names = (row["source"] for row in sources.toLocalIterator())
        while batch := list(islice(names, 64 * movers)):
            list(pool.map(move, batch))
