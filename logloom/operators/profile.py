"""Profiles of events, labels and columns.

Sums over the matrix come from the long form, where zero cells have no row. Squares and
products are added as decimals: a count of 1e11 squared does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from logloom.functions.text import event_number, preview
from logloom.operators.counts import entity_count
from logloom.session import broadcast_if_small, stage

BIG = "decimal(38,0)"


def event_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("event_id").agg(F.sum("n").alias("n"))


def top_events(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent events with rank and share of all counted lines in percent."""
    totals = event_totals(counts)
    everything = counts.agg(F.sum("n")).scalar()
    top = totals.orderBy(F.desc("n"), event_number(F.col("event_id"))).limit(k)
    rank = F.row_number().over(W.orderBy(F.desc("n"), event_number(F.col("event_id"))))
    return top.select(rank.alias("rank"), "event_id", "n", (F.col("n") * 100.0 / everything).alias("pct"))


def rare_events(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` least frequent events."""
    return event_totals(counts).orderBy("n", event_number(F.col("event_id"))).limit(k)


def label_distribution(labelled: DataFrame) -> DataFrame:
    """Rows per label with their share of all labelled rows in percent."""
    counts = labelled.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))
    return counts.select("label", "n", (F.col("n") * 100.0 / F.sum("n").over(W.partitionBy())).alias("pct"))


def class_ratio(labelled: DataFrame, negative: str = "Normal", positive: str = "Anomaly") -> DataFrame:
    """Sizes of two classes and their ratio, NULL when one is empty."""
    sizes = labelled.agg(
        F.count_if(F.col("label") == negative).alias("negatives"), F.count_if(F.col("label") == positive).alias("positives")
    )
    ratio = F.when(F.col("negatives") > 0, F.try_divide(F.col("negatives").cast("double"), F.col("positives")))
    return sizes.withColumn("ratio", ratio)


def majority_ratio(labelled: DataFrame) -> DataFrame:
    """Size of the largest label over the second largest."""
    sizes = labelled.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "label").limit(2)
    return top.agg(F.max("n").alias("largest"), F.min("n").alias("second"), F.count("*").alias("labels")).select(
        "largest",
        F.when(F.col("labels") == 2, F.col("second")).alias("second"),
        F.when(F.col("labels") == 2, F.col("largest").cast("double") / F.col("second")).alias("ratio"),
    )


def anomaly_rate(labelled: DataFrame, positive: str = "Anomaly") -> DataFrame:
    """Rows with the positive label in percent of all rows, unlabelled ones included."""
    hits = F.count_if(F.col("label") == positive)
    return labelled.agg(
        F.count("*").alias("entities"), hits.alias("anomalies"), F.try_divide(hits * 100.0, F.count("*")).alias("rate_pct")
    )


def entity_coverage(events: DataFrame, entity_col: str) -> DataFrame:
    """Lines that name an entity, and distinct entities."""
    return events.agg(
        F.count(entity_col).alias("entity_lines"), F.count_distinct(entity_col).alias("entities")
    )


def parse_stats(events: DataFrame) -> DataFrame:
    """Lines, lines whose header matched, and distinct events."""
    return events.agg(
        F.count("*").alias("lines"),
        F.count_if("is_parsed").alias("parsed_lines"),
        F.count_distinct("EventId").alias("templates"),
    )


def top_templates(templates: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` templates with most lines, texts cut for display."""
    top = templates.orderBy(F.desc("Occurrences"), event_number(F.col("EventId"))).limit(k)
    return top.select("EventId", "Occurrences", preview(F.col("EventTemplate")).alias("preview"))


def events_by_label(counts: DataFrame, labels: DataFrame, label_values: list[str], k: int = 10) -> DataFrame:
    """Total per event and label for the ``k`` events with the largest labelled totals."""
    wide = (
        counts.join(labels, "entity_id")
        .filter(F.col("label").isin(label_values))
        .groupBy("event_id")
        .pivot("label", label_values)
        .agg(F.sum("n"))
        .na.fill(0, subset=label_values)
    )
    total = F.lit(0).cast("bigint")
    for value in label_values:
        total = total + F.col(f"`{value}`")
    top = wide.withColumn("total", total).orderBy(F.desc("total"), event_number(F.col("event_id"))).limit(k)
    return top.select("event_id", *label_values, "total")


def top_events_per_label(counts: DataFrame, labels: DataFrame, k: int = 10) -> DataFrame:
    """Per label the ``k`` most frequent events with their share within the label in percent."""
    sums = counts.join(labels, "entity_id").filter(F.col("label").isNotNull()).groupBy("label", "event_id").agg(F.sum("n").alias("n"))
    per_label = sums.groupBy("label").agg(F.sum("n").alias("label_total"))
    order = W.partitionBy("label").orderBy(F.desc("n"), event_number(F.col("event_id")))
    ranked = sums.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(per_label, "label").select(
        "label", "rank", "event_id", "n", (F.col("n") * 100.0 / F.col("label_total")).alias("pct")
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: how many and what share; worst first when shown."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = counts.unpivot("_rows", df.columns, "column", "missing")
    return long.filter("missing > 0").select(
        "column", "missing", (F.col("missing") * 100.0 / F.col("_rows")).alias("missing_pct")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null values, rows."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    long = counts.unpivot("rows", df.columns, "column", "non_null")
    return long.select("column", F.element_at(types, F.col("column")).alias("type"), "non_null", "rows")


# Moments ---------------------------------------------------------------------------------


def event_moments(counts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Per event: event_no, number of entities, sum and sum of squares over all entities.

    ``events`` (event_id) are the matrix columns: others are left out, and a column without
    any count has sums of zero.
    """
    n = F.col("n").cast("decimal(18,0)")
    sums = counts.groupBy("event_id").agg(
        F.sum(n).cast(BIG).alias("total"), F.sum((n * n).cast(BIG)).alias("squares")
    )
    if events is not None:
        sums = events.select("event_id").distinct().join(sums, "event_id", "left")
    zero = F.lit(0).cast(BIG)
    return sums.select(
        "event_id",
        event_number(F.col("event_id")).alias("event_no"),
        entity_count(counts).scalar().alias("entities"),
        F.coalesce("total", zero).alias("total"),
        F.coalesce("squares", zero).alias("squares"),
    )


def _spread(total: Column, squares: Column, entities: Column) -> Column:
    """``N * sum of squares - (sum)^2``, exact until the cast to double."""
    return ((entities.cast("decimal(18,0)") * squares).cast(BIG) - (total * total).cast(BIG)).cast("double")


def event_variance(counts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Sample variance per event over all entities, zeros included; NULL for one entity."""
    moments = event_moments(counts, events)
    size = F.col("entities").cast("double")
    spread = _spread(F.col("total"), F.col("squares"), F.col("entities"))
    return moments.select("event_id", "event_no", F.try_divide(spread, size * (size - 1)).alias("variance"))


def low_variance(variances: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Events whose variance lies below the threshold."""
    return variances.filter(F.col("variance") < threshold)


def event_products(counts: DataFrame, block_rows: int = 2048, tile: int = 512) -> DataFrame:
    """(no_a, no_b, xy): sum over entities of the product of two event counts, a < b; exact.

    A self-join on the entity would send every pair of every entity through the shuffle. Each
    task multiplies dense tiles instead, ``block_rows`` entities by two times ``tile`` events, and
    sends one sum per pair of events that meet. Counts are cut into limbs of 21 bits: a product of
    limbs has 42, and 2048 of them add up to 53, so every float is exact. The sums are put
    together as decimals. The lists of an entity are as long as its distinct events.
    """
    if block_rows > 2048:
        raise ValueError("more than 2048 products of limbs don't add up exactly")

    # Defined here so that it travels to the executors by value; they need not have this package.
    def block_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                sizes = pc.list_value_length(part.column("events")).to_numpy(zero_copy_only=False)
                n = part.column("ns").flatten().to_numpy()
                names, column = np.unique(part.column("events").flatten().to_numpy(), return_inverse=True)
                if len(names) < 2:
                    continue
                row = np.repeat(np.arange(part.num_rows), sizes)
                limbs = max(1, -(-int(n.max()).bit_length() // 21))
                order = np.argsort(column, kind="stable")
                row, column, n = row[order], column[order], n[order]
                edges = np.searchsorted(column, np.arange(0, len(names) + tile, tile))

                def dense(k: int, limb: int) -> np.ndarray:
                    cut = slice(edges[k], edges[k + 1])
                    block = np.zeros((part.num_rows, min(tile, len(names) - k * tile)))
                    block[row[cut], column[cut] - k * tile] = (n[cut] >> (21 * limb)) & ((1 << 21) - 1)
                    return block

                for i in range(len(edges) - 1):
                    lefts = [dense(i, limb).T for limb in range(limbs)]
                    for j in range(i, len(edges) - 1):
                        for q in range(limbs):
                            right = dense(j, q)
                            for p in range(limbs):
                                products = lefts[p] @ right
                                if i == j:
                                    products = np.triu(products, 1)
                                a, b = np.nonzero(products)
                                if len(a):
                                    arrays = (names[a + i * tile], names[b + j * tile], np.full(len(a), p + q), products[a, b].astype(np.int64))
                                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["no_a", "no_b", "shift", "xy"])

    per_entity = counts.groupBy("entity_id").agg(
        F.collect_list(event_number(F.col("event_id"))).alias("events"),
        F.collect_list(F.col("n").cast("bigint")).alias("ns"),
    )
    sums = per_entity.select("events", "ns").mapInArrow(block_products, "no_a bigint, no_b bigint, shift bigint, xy bigint")
    weight = F.array(*[F.lit(Decimal(2 ** (21 * k))).cast(BIG) for k in range(6)])
    whole = (F.col("xy").cast("decimal(19,0)") * F.get(weight, F.col("shift").cast("int"))).cast(BIG)
    return sums.groupBy("no_a", "no_b").agg(F.sum(whole).cast(BIG).alias("xy"))


def _matrix_counts(counts: DataFrame, events: DataFrame | None) -> DataFrame:
    if events is None:
        return counts
    return counts.join(broadcast_if_small(events.select("event_id").distinct()), "event_id", "left_semi")


_MOMENTS = ("event_id", "event_no", "entities", "total", "spread")


def _spreads(counts: DataFrame, events: DataFrame | None) -> DataFrame:
    """``_MOMENTS`` per matrix column, staged."""
    moments = event_moments(counts, events)
    spread = _spread(F.col("total"), F.col("squares"), F.col("entities"))
    return stage(moments.select("event_id", "event_no", "entities", "total", spread.alias("spread")), "moments")


def _sided(moments: DataFrame, side: str) -> DataFrame:
    return moments.select([F.col(c).alias(f"{c}_{side}") for c in moments.columns])


def _with_r(pairs: DataFrame) -> DataFrame:
    """Pearson's r of pairs (columns of ``_sided`` for a and b, xy)."""
    joint = (F.col("entities_a").cast("decimal(18,0)") * F.coalesce("xy", F.lit(0).cast(BIG))).cast(BIG)
    shared = (joint - (F.col("total_a") * F.col("total_b")).cast(BIG)).cast("double")
    r = F.try_divide(shared, F.sqrt("spread_a") * F.sqrt("spread_b"))
    return pairs.select(
        F.col("event_id_a").alias("event_a"), F.col("event_id_b").alias("event_b"), "event_no_a", "event_no_b", r.alias("r")
    )


def event_correlation(counts: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Pearson correlation of every two events a < b over all entities, zeros included.

    NULL when one of them is constant. The rows are the upper triangle of the matrix, which
    each event spans by listing the places after its own.
    """
    moments = _spreads(counts, events)
    # One row per matrix column.
    one = moments.withColumn("place", F.row_number().over(W.orderBy("event_no")))
    size = moments.agg(F.count("*")).scalar().cast("int")
    left = _sided(one, "a").filter(F.col("place_a") < size).withColumn("place_b", F.explode(F.sequence(F.col("place_a") + 1, size)))
    products = event_products(_matrix_counts(counts, events)).select(
        F.col("no_a").alias("event_no_a"), F.col("no_b").alias("event_no_b"), "xy"
    )
    return _with_r(left.join(_sided(one, "b"), "place_b").join(products, ["event_no_a", "event_no_b"], "left"))


def strong_correlations(counts: DataFrame, limit: float, events: DataFrame | None = None) -> DataFrame:
    """The rows of ``event_correlation`` with ``abs(r) > limit`` (0 < limit), without spanning the matrix.

    Events that meet in some entity come from their products. Two events that never meet have
    r = -sqrt(f_a f_b) with f = total^2 / spread, which is strong only if one of them has f > limit; such an event
    stands in a good part of all entities (about half for 0.95), so there are no more of them than an entity has distinct events by a small factor.
    """
    moments = _spreads(counts, events).withColumn("f", F.try_divide(F.col("total").cast("double") ** 2, F.col("spread")))
    products = stage(event_products(_matrix_counts(counts, events)), "products").select(
        F.col("no_a").alias("event_no_a"), F.col("no_b").alias("event_no_b"), "xy"
    )
    met = products.join(_sided(moments, "a"), "event_no_a").join(_sided(moments, "b"), "event_no_b")
    slack = 1 - 1e-9
    row = F.struct(*_MOMENTS, "f")
    often = moments.filter(F.col("f") > limit * slack).agg(F.collect_list(row)).scalar()
    # Of two frequent events the later one lists the earlier; any other event lists all frequent ones.
    wanted = F.filter(
        "often",
        lambda x: (x["event_no"] != F.col("event_no"))
        & (x["f"] * F.col("f") > limit * limit * slack)
        & ((F.col("f") <= limit * slack) | (x["event_no"] < F.col("event_no"))),
    )
    listed = moments.filter(F.col("f").isNotNull()).withColumn("often", often).withColumn("other", F.explode(wanted))
    listed = listed.select(row.alias("own"), "other")
    first = F.col("own.event_no") < F.col("other.event_no")
    sides = [
        F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{c}_{side}")
        for x, y, side in (("own", "other", "a"), ("other", "own", "b"))
        for c in _MOMENTS
    ]
    apart = listed.select(*sides).join(products.drop("xy"), ["event_no_a", "event_no_b"], "left_anti")
    apart = apart.withColumn("xy", F.lit(None).cast(BIG))
    columns = [f"{c}_{side}" for side in "ab" for c in _MOMENTS] + ["xy"]
    return _with_r(met.select(*columns).unionByName(apart.select(*columns))).filter(F.abs("r") > limit)


def correlated_pairs(correlation: DataFrame, low: float = 0.9, symmetric: bool = False) -> DataFrame:
    """Pairs with ``low < r < 1``. Perfect pairs are left out, and so are negative ones."""
    pairs = correlation.filter((F.col("r") > low) & (F.col("r") < 1 - 1e-12)).select("event_a", "event_b", "r")
    if symmetric:
        pairs = pairs.unionByName(pairs.select(F.col("event_b").alias("event_a"), F.col("event_a").alias("event_b"), "r"))
    return pairs


def top_event_correlation(counts: DataFrame, k: int = 20) -> DataFrame:
    """Correlation among the ``k`` most frequent events, over all entities."""
    return event_correlation(counts, top_events(counts, k).select("event_id"))
