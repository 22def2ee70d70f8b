"""Label sources: a table of (entity, label), or entity ids listed in a prose text file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.text import clean_line

# Fixed value: the shape of an instance id in a label text.
UUID_LINE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def read_label_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """(entity_id, label) from a headed two-column CSV; None when the file does not exist."""
    try:
        return spark.read.csv(path, header=True, schema="entity_id string, label string", enforceSchema=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def label_ids(lines: DataFrame, pattern: str = UUID_LINE) -> DataFrame:
    """Distinct ids (entity_id) among text lines (value): lines that are an id and nothing else."""
    line = clean_line(F.col("value"))
    return lines.select(line.alias("entity_id")).filter(F.col("entity_id").rlike(pattern)).distinct()


def read_label_ids(spark: SparkSession, path: str, pattern: str = UUID_LINE) -> DataFrame:
    return label_ids(spark.read.text(path), pattern)
