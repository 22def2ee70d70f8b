"""Append-only ingest ledger: what was read, with which content, and when.

Rows: source, fingerprint, ingested_at, num_lines, num_templates, cleared, and the length and time of the file when it was
read. The newest row of a source counts; a row with ``cleared`` forgets the source, or all of them when source is NULL.

Next to the table stands a manifest: source, time and checksum of every row, written after it. A
row that the manifest names and the table no longer holds was lost to damage. What it said is
unknown, so its source counts as forgotten from then on and is read again, while all other rows stay.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import stage

LEDGER_SCHEMA = (
    "source string, fingerprint string, ingested_at timestamp, num_lines bigint, "
    "num_templates bigint, cleared boolean, length bigint, modified_at timestamp"
)
_MANIFEST = "source string, at_micros bigint, cleared boolean, mark bigint"


def _mark() -> Column:
    """Checksum of a ledger row."""
    return F.xxhash64(
        "source", "fingerprint", F.unix_micros("ingested_at"), "num_lines", "num_templates", "cleared", "length", F.unix_micros("modified_at")
    ).alias("mark")


def _read(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    """What can be read of a table; a missing one is empty, unreadable files are left out."""
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def lost_rows(spark: SparkSession, path: str) -> DataFrame:
    """(source, ingested_at, cleared) of the rows that the manifest names and the table has lost."""
    rows = _read(spark, path, LEDGER_SCHEMA, "parquet").select(_mark())
    named = _read(spark, f"{path}.manifest", _MANIFEST, "json").filter("mark IS NOT NULL")
    return named.join(rows, "mark", "left_anti").select("source", F.timestamp_micros("at_micros").alias("ingested_at"), "cleared").distinct()


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All ledger rows; a missing or wholly unreadable ledger without a manifest is an empty one.

    A lost row stands as one that forgets its source.
    """
    rows = _read(spark, path, LEDGER_SCHEMA, "parquet")
    lost = lost_rows(spark, path).withColumn("cleared", F.lit(True))
    return rows.unionByName(lost, allowMissingColumns=True)


def _append(rows: DataFrame, path: str) -> None:
    """The rows, then what the manifest keeps of them."""
    held = stage(rows, "ledger-rows")
    held.write.mode("append").parquet(path)
    named = held.select("source", F.unix_micros("ingested_at").alias("at_micros"), "cleared", _mark())
    named.write.mode("append").json(f"{path}.manifest")


def _now() -> Column:
    return F.timestamp_micros(F.lit(time.time_ns() // 1000)).alias("ingested_at")


def latest(ledger: DataFrame) -> DataFrame:
    """The newest row per source, without cleared sources."""
    all_cleared = ledger.filter("cleared and source is null").agg(F.max("ingested_at").alias("at")).scalar()
    file = [c for c in ("length", "modified_at") if c in ledger.columns]
    row = F.struct("ingested_at", "fingerprint", "num_lines", "num_templates", "cleared", *file)
    newest = ledger.filter("source is not null").groupBy("source").agg(F.max_by(row, "ingested_at").alias("row"))
    return newest.select("source", "row.*").filter(
        ~F.col("cleared") & (all_cleared.isNull() | (F.col("ingested_at") > all_cleared))
    ).drop("cleared")


def unchanged(files: DataFrame, known: DataFrame) -> DataFrame:
    """(source, fingerprint) of the files (``list_files``) that have the length and time of their last ingest.

    They need not be read. A file without a trusted time is not among them.
    """
    seen = known.select("source", "fingerprint", F.col("length").alias("known_length"), F.col("modified_at").alias("known_time"))
    same = (F.col("length") == F.col("known_length")) & (F.col("modified_at") == F.col("known_time"))
    return files.join(seen, "source").filter(same).select("source", "fingerprint")


def plan_ingest(wanted: DataFrame, present: DataFrame, known: DataFrame) -> DataFrame:
    """What to do with every wanted source.

    ``wanted``: source. ``present``: source, fingerprint of the files that exist. ``known``:
    ``latest(...)``. Decisions: parse (new), reparse (content changed), skip (same content),
    archived (file gone but known), missing (neither file nor record).
    """
    now = F.col("p.fingerprint")
    then = F.col("k.fingerprint")
    decision: Column = (
        F.when(now.isNull() & F.col("k.source").isNotNull(), "archived")
        .when(now.isNull(), "missing")
        .when(F.col("k.source").isNull(), "parse")
        .when(now == then, "skip")
        .otherwise("reparse")
    )
    return (
        wanted.alias("w")
        .join(present.alias("p"), F.col("w.source") == F.col("p.source"), "left")
        .join(known.alias("k"), F.col("w.source") == F.col("k.source"), "left")
        .select(
            F.col("w.source").alias("source"),
            decision.alias("decision"),
            now.alias("fingerprint"),
            F.col("k.num_lines").alias("known_lines"),
            F.col("k.num_templates").alias("known_templates"),
        )
    )


def record(parsed: DataFrame, path: str) -> None:
    """Append one row per parsed source (source, fingerprint, num_lines, num_templates; length, modified_at)."""
    file = [
        (F.col(name) if name in parsed.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in (("length", "bigint"), ("modified_at", "timestamp"))
    ]
    rows = parsed.select(
        "source",
        "fingerprint",
        _now(),
        F.col("num_lines").cast("bigint"),
        F.col("num_templates").cast("bigint"),
        F.lit(False).alias("cleared"),
        *file,
    )
    _append(rows, path)


def clear(spark: SparkSession, path: str, source: str | None = None) -> None:
    """Forget one source, or all of them."""
    values = {"source": F.lit(source), "cleared": F.lit(True), "ingested_at": _now()}
    fields = spark.createDataFrame([], LEDGER_SCHEMA).schema
    rows = spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    _append(rows, path)


def read_json_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON ledger ``{source: {file_hash, last_parsed, num_lines, num_templates}}``."""
    entry = "struct<file_hash:string,last_parsed:string,num_lines:bigint,num_templates:bigint>"
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("source", "e"))
    return entries.select(
        "source",
        F.col("e.file_hash").alias("fingerprint"),
        F.col("e.last_parsed").cast("timestamp").alias("ingested_at"),
        F.col("e.num_lines").alias("num_lines"),
        F.col("e.num_templates").alias("num_templates"),
        F.lit(False).alias("cleared"),
    )
