"""Stratified folds that survive recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

HASH_DIGITS = 3


def stratified_folds(rows: DataFrame, folds: int = 10, seed: int = 42, target: str = "target") -> DataFrame:
    """Add ``fold`` (1..folds): per class, sizes of any two folds differ by at most one.

    Rows of a class are ranked by a hash of ``entity_id`` and the seed, never by ``rand()``,
    which changes when a lost task runs again. The rank is the place within a hash-prefix
    bucket plus the sizes of the buckets before it, so a class of any size is ranked by many
    tasks.
    """
    order = F.md5(F.concat(F.col("entity_id").cast("string"), F.lit(f":{seed}")))
    hashed = rows.withColumn("_hash", order).withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))
    sizes = hashed.groupBy(target, "_bucket").agg(F.count("*").alias("_n"))
    # At most 16 ** HASH_DIGITS rows per class.
    before = W.partitionBy(target).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(target, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(target, "_bucket").orderBy("_hash", "entity_id"))
    ranked = hashed.withColumn("_rank", inside).join(F.broadcast(offsets), [target, "_bucket"])
    fold = (F.col("_before") + F.col("_rank") - 1) % folds + 1
    return ranked.select(*rows.columns, fold.cast("int").alias("fold"))
