"""Cross-validated random forests whose trees are grown by tasks, many trees side by side.

Spark's forest sends histograms of every node through a shuffle, level after level, which for deep trees over tables
that fit a task is nearly all of its time. Here every task holds the binned rows and grows whole trees, with the rules of
Spark's forest: bins, bootstrap by Poisson weights, features drawn per node, Gini gain, at most ``max_depth`` levels, and
two leaves of one prediction become one. Draws depend on seed, fold and tree alone, and votes are added as integers, so
scores don't depend on partitioning.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import stage

# Tasks get the functions below with their job, so workers need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bins of a feature, and rows whose values place them: those of Spark's forest.
MAX_BINS, SPLIT_ROWS = 32, 10_000
# Votes are added as integers of this unit.
UNIT = 1 << 40
# A sum of weights carries that of the positives in its upper bits; both stay exact in a double.
POSITIVE = float(1 << 26)
# Tasks per core: a task that ends early finds another part of a forest.
TASKS_PER_CORE = 4
# A task gets a copy of the binned rows, so there are at most so many tasks, and so many cells and features.
MOST_TASKS, MOST_CELLS, MOST_FEATURES = 64, 1 << 26, 1000


def thresholds(values: np.ndarray, rows: int, bins: int = MAX_BINS) -> np.ndarray:
    """Bounds of at most ``bins`` bins of a feature with ``values`` beside zeros in ``rows`` rows.

    Between all neighbouring values if these are few, else after equal shares of the rows.
    """
    values = values[values != 0]
    found, counts = np.unique(values, return_counts=True)
    if rows > len(values):
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, rows - len(values))
    between = (found[:-1] + found[1:]) / 2.0
    if len(between) < bins:
        return between
    share, kept = rows / bins, []
    target, passed = share, float(counts[0])
    for i in range(1, len(found)):
        before, passed = passed, passed + counts[i]
        if abs(before - target) < abs(passed - target):
            kept.append(between[i - 1])
            target += share
    return np.array(kept[: bins - 1])


def binned(values: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Bin of every value, a column per feature: a value that equals a bound belongs below it."""
    out = np.empty(values.shape, np.uint8)
    for f, cuts in enumerate(bounds):
        out[:, f] = np.searchsorted(cuts, values[:, f], side="left")
    return out


def _drawn(rng: np.random.Generator, nodes: int, features: int, picked: int) -> np.ndarray:
    """``picked`` different features for each node, any set being as likely as any other (Floyd)."""
    out = np.empty((picked, nodes), np.intp)
    for i, top in enumerate(range(features - picked, features)):
        one = rng.integers(0, top + 1, nodes)
        again = (out[:i] == one).any(axis=0)
        out[i] = np.where(again, top, one)
    return out


def _unpack(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and positive weight."""
    positive = np.floor(sums / POSITIVE)
    return sums - positive * POSITIVE, positive


def _best_splits(
    bins: np.ndarray, at: np.ndarray, node: np.ndarray, packed: np.ndarray, total: np.ndarray,
    widths: np.ndarray, drawn: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain (0: none), feature, last bin to the left, and packed weight to the left."""
    nodes = len(total)
    weight, positive = _unpack(total)
    gain, feature = np.zeros(nodes), np.zeros(nodes, np.intp)
    last, left = np.zeros(nodes, np.intp), np.zeros(nodes)
    for chosen in drawn:
        width = widths[chosen]
        start = np.cumsum(width) - width
        cells = np.bincount(start[node] + bins[at + chosen[node]], packed, int(width.sum()))
        sums = np.cumsum(cells)
        owner = np.repeat(np.arange(nodes), width)
        sums -= (sums[start] - cells[start])[owner]
        below, hits = _unpack(sums)
        all_of = weight[owner]
        # The Gini gain of a node's splits goes with the square of this difference, which is 0 where nothing is gained.
        apart = hits * all_of - below * positive[owner]
        spread = below * (all_of - below)
        score = np.divide(apart * apart, spread, out=np.zeros(len(spread)), where=spread > 0)
        top = np.maximum.reduceat(score, start)
        better = top > gain
        if better.any():
            hit = np.flatnonzero((score == top[owner]) & better[owner])[::-1]
            first = np.zeros(nodes, np.intp)
            first[owner[hit]] = hit
            first = first[better]
            gain[better], feature[better] = top[better], chosen[better]
            last[better], left[better] = first - start[better], sums[first]
    return gain, feature, last, left


def tree_shares(
    bins: np.ndarray, target: np.ndarray, weight: np.ndarray, held: np.ndarray, widths: np.ndarray,
    picked: int, max_depth: int, rng: np.random.Generator,
) -> np.ndarray:
    """Share of positives in the leaf that each row of ``held`` reaches, in a tree over the weighted rows.

    ``bins``: rows times features; ``held``: bins of the held-out rows.
    """
    features = bins.shape[1]
    flat, held_flat = bins.reshape(-1), held.reshape(-1)
    rows = np.flatnonzero(weight)
    packed = weight[rows] * (1.0 + target[rows] * POSITIVE)
    at, node = rows * features, np.zeros(len(rows), np.intp)
    asked, asked_node = np.arange(len(held)), np.zeros(len(held), np.intp)
    reached, reached_level = np.zeros(len(held), np.intp), np.zeros(len(held), np.intp)
    totals, children = [np.array([packed.sum()])], []
    for depth in range(max_depth + 1):
        total = totals[depth]
        n, p = _unpack(total)
        child = np.full(len(total), -1)
        split = np.flatnonzero((p > 0) & (p < n)) if depth < max_depth else np.empty(0, np.intp)
        if len(split):
            slot = np.full(len(total), -1)
            slot[split] = np.arange(len(split))
            own = slot[node]
            kept = own >= 0
            at, packed, own = at[kept], packed[kept], own[kept]
            drawn = _drawn(rng, len(split), features, picked)
            gain, feature, last, left = _best_splits(flat, at, own, packed, total[split], widths, drawn)
            good = gain > 0
            first = np.where(good, 2 * np.cumsum(good) - 2, -1)
            child[split] = first
            kept = good[own]
            at, packed, own = at[kept], packed[kept], own[kept]
            node = first[own] + (flat[at + feature[own]] > last[own])
            following = np.stack([left[good], (total[split] - left)[good]], axis=1).reshape(-1)
        children.append(child)
        ends = child[asked_node] < 0
        reached[asked[ends]], reached_level[asked[ends]] = asked_node[ends], depth
        if not (child >= 0).any():
            break
        totals.append(following)
        asked, own = asked[~ends], slot[asked_node[~ends]]
        asked_node = first[own] + (held_flat[asked * features + feature[own]] > last[own])
    # Two leaves of one prediction are one leaf, from the bottom up; what lies below it has its share.
    leaves, votes = [], []
    for total, child in zip(reversed(totals), reversed(children)):
        n, p = _unpack(total)
        leaf, inner = child < 0, np.flatnonzero(child >= 0)
        if len(inner):
            one, two = child[inner], child[inner] + 1
            leaf[inner] = leaves[-1][one] & leaves[-1][two] & (votes[-1][one] == votes[-1][two])
        leaves.append(leaf)
        votes.append(p > n - p)
    leaves.reverse()
    shares = np.zeros(len(held))
    above = None
    for depth, (total, child) in enumerate(zip(totals, children)):
        n, p = _unpack(total)
        share = p / n
        if above is not None:
            under, value = above
            share = np.where(np.isnan(value[under]), share, value[under])
        here = reached_level == depth
        shares[here] = share[reached[here]]
        inner = np.flatnonzero(child >= 0)
        under = np.empty(2 * len(inner), np.intp)
        under[child[inner]] = under[child[inner] + 1] = inner
        above = under, np.where(leaves[depth], share, np.nan)
    return shares


def fits(rows: int, features: int) -> bool:
    """Whether a task may hold the binned rows of a table; beyond that the cluster grows every tree together."""
    return 0 < features <= MOST_FEATURES and rows * features <= MOST_CELLS


def _keyed(table: DataFrame, seed: int) -> DataFrame:
    """Values as an array, and a key that orders rows wherever they lie: equal keys are equal rows."""
    values = vector_to_array("features")
    return table.select("fold", "entity_id", "target", values.alias("values")).withColumn(
        "key", F.xxhash64(F.col("entity_id").cast("string"), "target", "values", F.lit(seed))
    )


def _matrix(column: pa.Array, features: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, features)


def _fold_bounds(keyed: DataFrame, sizes: dict[int, int], features: int) -> dict[int, list[np.ndarray]]:
    """Bounds of the bins of every fold, from rows of the other folds only."""
    rows = sum(sizes.values())
    most = 1 << 20
    share = math.ceil(most * SPLIT_ROWS / max(1, rows - max(sizes.values())))
    found = keyed.filter(F.pmod("key", F.lit(most)) < share).select("fold", "values").toArrow().combine_chunks()
    fold = found["fold"].to_numpy()
    values = _matrix(found["values"].combine_chunks(), features) if len(fold) else np.empty((0, features))
    bounds = {}
    for held in sizes:
        train = values[fold != held]
        bounds[held] = [thresholds(train[:, f], len(train)) for f in range(features)]
    return bounds


def fold_scores(table: DataFrame, sizes: dict[int, int], features: int, trees: int, max_depth: int, seed: int) -> DataFrame:
    """Held-out scores (fold, entity_id, target, prediction, score) of a forest per fold, grown from the other folds.

    ``table``: fold, entity_id, features, target (0 or 1), staged; ``sizes``: rows per fold. Rows are binned once for
    every fold and dealt to the tasks, each of which grows some trees of one fold.
    """
    spark = table.sparkSession
    keyed = _keyed(table, seed)
    folds = sorted(sizes)
    bounds = _fold_bounds(keyed, sizes, features)
    widths = {fold: np.array([len(cuts) + 1 for cuts in bounds[fold]]) for fold in folds}

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch["values"], features)
            rows = np.concatenate([binned(values, bounds[fold]) for fold in folds], axis=1)
            packed = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.record_batch([*(batch[name] for name in passed), packed], [*passed, "bins"])

    passed = ("key", "fold", "entity_id", "target")
    schema = ", ".join(f"`{name}` {keyed.schema[name].dataType.simpleString()}" for name in passed)
    rows = keyed.mapInArrow(bin_rows, f"{schema}, bins binary")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "binned")

    cores = spark.sparkContext.defaultParallelism
    parts = max(1, min(trees, math.ceil(TASKS_PER_CORE * cores / len(folds)), MOST_TASKS // len(folds)))
    tasks = parts * len(folds)
    place = F.floor(F.col("task") / parts).cast("int")
    held = F.get(F.array(*[F.lit(fold) for fold in folds]), place) == F.col("fold")
    dealt = rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).select(
        "task", "key", "target", held.alias("held"), F.when(held, F.col("row")).alias("row"),
        F.when(held, F.col("entity_id")).alias("entity_id"),
        F.expr(f"substring(bins, cast(floor(task / {parts}) as int) * {features} + 1, {features})").alias("bins"),
    )
    picked = math.ceil(math.sqrt(features))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).combine_chunks()
        del found
        task = table["task"][0].as_py()
        number, part = divmod(task, parts)
        fold = folds[number]
        out = table.filter(table["held"]).select(["row", "entity_id", "target"])
        bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(-1, features)
        target, is_held = table["target"].to_numpy().astype(np.float64), table["held"].to_numpy()
        held_bins = bins[is_held]
        order = np.flatnonzero(~is_held)
        order = order[np.argsort(table["key"].to_numpy()[order], kind="stable")]
        del table
        bins, target = bins[order], target[order]
        votes = np.zeros(len(held_bins), np.int64)
        for tree in range(trees * part // parts, trees * (part + 1) // parts):
            rng = np.random.default_rng([seed % (1 << 32), number, tree])
            weight = rng.poisson(1.0, len(bins)).astype(np.float64)
            shares = tree_shares(bins, target, weight, held_bins, widths[fold], picked, max_depth, rng)
            votes += np.rint(shares * UNIT).astype(np.int64)
        columns = [pa.array(np.full(len(votes), fold, np.int32)), *(c.combine_chunks() for c in out.columns), pa.array(votes)]
        yield pa.record_batch(columns, ["fold", *out.column_names, "votes"])

    kinds = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in ("row", "entity_id", "target"))
    voted = dealt.repartitionById(tasks, "task").mapInArrow(grow, f"fold int, {kinds}, votes bigint")
    votes = voted.groupBy("fold", "row", "entity_id", "target").agg(F.sum("votes").alias("votes"))
    whole = trees * UNIT
    return votes.select(
        "fold", "entity_id", "target",
        (2 * F.col("votes") > F.lit(whole)).cast("int").alias("prediction"), (F.col("votes") / F.lit(float(whole))).alias("score"),
    )
