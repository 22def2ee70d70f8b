"""Tables the stages exchange. All are Parquet; the matrix can also be exported as CSV."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_events(events: DataFrame, path: str) -> None:
    """Structured events, partitioned by source.

    Only the partitions of the sources at hand are replaced, so a file that is read again
    replaces its own rows and a retried job leaves no duplicates.
    """
    events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def drop_sources(spark: SparkSession, path: str, sources: DataFrame) -> None:
    """Remove the partitions of ``sources`` (source) from the structured events."""
    rows = spark.read.parquet(path).select("source", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
    folders = rows.join(sources.select("source"), "source", "left_semi").select("folder").distinct()
    for row in folders.toLocalIterator():
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["folder"]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_events(spark: SparkSession, path: str, sources: list[str] | None = None) -> DataFrame:
    """Structured events; ``sources`` prunes to those partitions, absent ones are skipped."""
    events = spark.read.parquet(path)
    return events if sources is None else events.filter(F.col("source").isin(sources))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_matrix_csv(matrix: DataFrame, path: str) -> None:
    """Wide matrix as headed CSV parts, sorted by entity within and across parts."""
    matrix.orderBy(matrix.columns[0]).write.mode("overwrite").csv(path, header=True)


def _headed(batches: Iterator[pa.RecordBatch], header: str) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
    for batch in batches:
        yield pa.RecordBatch.from_arrays(batch.columns, ["value"])


def export_cells_csv(matrix: DataFrame, columns: list[str], path: str) -> None:
    """The CSV of ``export_matrix_csv`` from a matrix of any width, whose counts are one array ``cells``.

    Lines are put together as text, so no plan has a column per event; the header stands on top of every part.
    """
    names = [c for x in matrix.columns for c in (columns if x == "cells" else [x])]
    values = [F.array_join("cells", ",") if x == "cells" else F.to_csv(F.struct(x)) for x in matrix.columns]
    ordered = matrix.orderBy(matrix.columns[0]).select(F.concat_ws(",", *values).alias("value"))
    ordered.mapInArrow(partial(_headed, header=",".join(names)), "value string").write.mode("overwrite").text(path)
