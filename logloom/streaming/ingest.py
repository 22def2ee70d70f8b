"""New log files as a stream: every file is read once, parsed, and optionally archived.

``ingest_log_stream`` writes what a batch ingest writes (events with line numbers and templates, and the
dictionary), so the later steps read either. ``count_stream`` keeps running counts in few files.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logloom.functions.formats import LogFormat, Mask, MiningConfig
from logloom.functions.text import signature
from logloom.operators.counts import merge_counts
from logloom.operators.parse import parse_lines, structured
from logloom.operators.templates import current_dictionary
from logloom.plans.structure import structure
from logloom.session import drop_path, stage
from logloom.sources.lines import NumberedScan, clean_lines, scanned, source_name
from logloom.sources.tables import read_or_none, write_events

# So many runs of batches of one size are merged into one.
FANOUT = 8


def _text_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int | None, archive: str | None) -> DataFrame:
    reader = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.text(folder)


def stream_lines(
    spark: SparkSession, folder: str, pattern: str = "*", files_per_batch: int | None = None, archive: str | None = None
) -> DataFrame:
    """Streaming lines (value, source) of new files below ``folder``; a source is its path there.

    With ``archive`` a file moves there once a later batch shows that it is done. The source
    knows files by name only: a file whose content changed is found by the ledger instead.
    """
    source = source_name(F.col("_metadata.file_path"), folder)
    return _text_stream(spark, folder, pattern, files_per_batch, archive).select("value", source.alias("source"))


def ingest_log_stream(
    spark: SparkSession,
    fmt: LogFormat,
    folder: str,
    out: str,
    checkpoint: str,
    mining: MiningConfig = MiningConfig(),
    pattern: str = "*",
    files_per_batch: int | None = None,
    archive: str | None = None,
    masks: tuple[Mask, ...] | None = None,
) -> StreamingQuery:
    """Append all new files below ``folder`` to the events and the dictionary in ``out``, then stop.

    A micro-batch holds whole files, so their lines are numbered as in a batch ingest. It looks templates up in the
    dictionary of the batches before it and writes what it adds under its own batch id, then the events of its
    files. A batch that runs again after a failure starts from the same dictionary, and replaces
    its own part of both tables.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        session = batch.sparkSession
        known = read_or_none(session, f"{out}/dictionary")
        if known is not None:
            # Staged once: mining reads the dictionary many times, and it lies in a folder per batch.
            known = stage(current_dictionary(known.filter(F.col("batch_id") < batch_id).drop("batch_id")), "known")
            known = None if known.isEmpty() else known
        result = structure(NumberedScan(batch, folder).lines(), fmt, mining, known, masks)
        new = result.dictionary
        if known is not None:
            new = new.join(known, ["event_no", "EventTemplate"], "left_anti")
        new.write.mode("overwrite").parquet(f"{out}/dictionary/batch_id={batch_id}")
        write_events(structured(result.events, fmt), f"{out}/events")

    lines = scanned(_text_stream(spark, folder, pattern, files_per_batch, archive))
    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parse_stream(lines: DataFrame, fmt: LogFormat) -> DataFrame:
    """Stateless parse of a line stream: header, entity and signature."""
    events = parse_lines(clean_lines(lines), fmt)
    return events.withColumn("signature", signature(F.col("Content"), fmt.masks))


def ingest_stream(events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append parsed events to a Parquet table, all that is there, then stop."""
    return (
        events.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("source")
        .trigger(availableNow=True)
        .start(out)
    )


def count_stream(
    events: DataFrame, entity_col: str, event_col: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Write the counts of every micro-batch as a run of its own, and merge runs by levels.

    There is no state that grows with the entities, and a batch that runs again overwrites its
    own run, so counts stay exact after a failure. Of ``FANOUT`` neighbouring runs of one size one is made, so after
    n batches fewer than ``FANOUT`` runs per level are left, and the levels grow with the logarithm of n. ``running_counts`` adds them up.
    """
    return (
        events.writeStream.foreachBatch(_batch_writer(entity_col, event_col, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batch_writer(entity_col: str, event_col: str, out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = (
            batch.filter(F.col(entity_col).isNotNull())
            .groupBy(F.col(entity_col).alias("entity_id"), F.col(event_col).alias("event"))
            .agg(F.count("*").alias("n"))
        )
        counts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        merge_runs(batch.sparkSession, out, batch_id)

    return write


def _runs(spark: SparkSession, out: str) -> dict[tuple[int, int], str]:
    """(first, last batch) of the finished runs, and their folders.

    A run is there when its job has put its mark, the last thing it does; what a killed job left does not count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(out)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in fs.listStatus(root) if fs.exists(root) else []:
        folder = status.getPath()
        name = re.fullmatch(r"batch_id=(\d+)(?:-(\d+))?", folder.getName())
        if name and fs.exists(path(folder, "_SUCCESS")):
            found[int(name[1]), int(name[2] or name[1])] = folder.toString()
    return found


def _live(runs: dict[tuple[int, int], str]) -> dict[tuple[int, int], str]:
    """The runs that no longer run holds: merged runs stand for all their batches, also for one that ran again."""
    return {
        (a, b): folder for (a, b), folder in runs.items() if not any(c <= a and b <= d and (c, d) != (a, b) for c, d in runs)
    }


def merge_runs(spark: SparkSession, out: str, batch_id: int, fanout: int | None = None) -> None:
    """Merge the runs that ``batch_id`` completes a level of, smallest first.

    A merged run appears as a whole with its mark; only then do the runs in it stop to count. They are deleted by the next
    merge, so a reader that has listed them still finds them.
    """
    fanout, size = fanout or FANOUT, 1
    while (batch_id + 1) % (size * fanout) == 0:
        size *= fanout
        first = batch_id + 1 - size
        runs = _runs(spark, out)
        live = _live(runs)
        for span in runs.keys() - live.keys():
            drop_path(spark, runs[span])
        parts = [folder for (a, b), folder in live.items() if first <= a and b <= batch_id]
        if (first, batch_id) not in live and parts:
            merged = merge_counts(_read_runs(spark, parts).withColumnRenamed("event", "event_id"))
            merged = merged.withColumnRenamed("event_id", "event")
            merged.write.mode("overwrite").parquet(f"{out}/batch_id={first}-{batch_id}")


def _read_runs(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema("entity_id string, event string, n bigint").parquet(*folders)


def running_counts(spark: SparkSession, out: str) -> DataFrame:
    """(entity_id, event, n) over all batches so far."""
    folders = sorted(_live(_runs(spark, out)).values())
    if not folders:
        return spark.createDataFrame([], "entity_id string, event string, n bigint")
    return _read_runs(spark, folders).groupBy("entity_id", "event").agg(F.sum("n").alias("n"))
