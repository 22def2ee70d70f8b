"""Exact ranks and running totals over big tables without a one-task window.

Rows are cut into value ranges by literal bounds, each range is ranked by itself, and the range
totals (a handful of rows) are carried forward. The bounds are literals taken once, so a task
that runs again puts every row into the same range.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Rows a single range may hold on average.
RANGE_ROWS = 1_000_000


def with_range(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Add ``range_no``, the number of the value range of ``key``; also return how many there are.

    Ranges ascend with the key. ``df`` should be staged, as it is counted here. The key is
    compared as a double, which never reverses the order of longs, so a later range never holds
    an earlier key.
    """
    ranges = df.count() // RANGE_ROWS + 1
    if ranges == 1:
        return df.withColumn("range_no", F.lit(0)), 1
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(F.col(key).cast("double"), shares, 10 * ranges)).first()[0]
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_key", outputCol="_range", handleInvalid="keep")
    ranged = bucketizer.transform(df.withColumn("_key", F.col(key).cast("double")))
    return ranged.withColumn("range_no", F.col("_range").cast("int")).drop("_key", "_range"), ranges


def running_totals(df: DataFrame, key: str, totals: dict[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """Add, per ``by`` group, the sum of columns over all rows with a smaller ``key``.

    ``totals`` maps output column to summed column; ``key`` is unique within a group, and ``df``
    should be staged.
    """
    ranged, ranges = with_range(df, key)
    inside = W.partitionBy(*by, "range_no").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(o) for o, c in totals.items()])
    if ranges == 1:
        return local.drop("range_no")
    sums = ranged.groupBy(*by, "range_no").agg(*[F.sum(c).alias(o) for o, c in totals.items()])
    # One row per range and group.
    before = W.partitionBy(*by).orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(
        *by, "range_no", *[F.coalesce(F.sum(o).over(before), F.lit(0)).alias(f"_{o}") for o in totals]
    )
    joined = local.join(carried, [*by, "range_no"])
    return joined.select(*df.columns, *[(F.col(o) + F.col(f"_{o}")).alias(o) for o in totals])


def number_rows(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number the rows of a staged table 1, 2, ... in the order of the unique ``key``."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), key, {out: "_one"})
    return ranked.withColumn(out, F.col(out) + 1).drop("_one")
