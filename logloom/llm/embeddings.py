"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products inside cells.

Equal vectors are collapsed first. A k-means fit on a bounded sample gives the cells, and every vector lives in
the cell of its nearest centre. Two vectors with cosine >= t are at most d = sqrt(2 - 2t) apart, so a
vector x of cell c can only be linked with one of cell c' if its distance to the plane between
the two centres, x(c - c') / |c - c'|, is at most d. Such vectors visit cell c' as guests (of two
cells the later one is visited), so no pair is lost at a border. Cells are cut into blocks of
bounded size; guests stream past a block in batches, and what leaves a batch is one count per
vector and one link per vector, of the block too, to the smallest vector it is connected with, never the pairs.

Contract: vectors that are null, zero, or hold null or non-finite components link with nothing.
Vectors of different lengths link with nothing of another length. Equal vectors are linked with
each other. Null ids are kept as rows; as a component id they come last. Repeated rows count as
vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.session import stage

COSINE = 0.95
# Vectors that the centres are fitted on, at most; and so many centres.
SAMPLE = 8192
CELLS = 256
# Vectors per cell that the number of cells aims at, and per block.
CELL_ROWS = 4096
BLOCK_ROWS = 2048
ROUNDS = 8


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: centres are the directions of the sums of their vectors."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        home = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return np.unique(centres, axis=0)


def visits(vectors: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of every vector, and which later cells it has to visit."""
    near = vectors @ centres.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * centres @ centres.T))
    gap = near[np.arange(len(near)), home][:, None] - near
    # A little slack for rounding only lets more vectors visit.
    guest = gap <= (reach + 1e-6) * apart[home] + 1e-9
    guest &= np.arange(len(centres))[None, :] > home[:, None]
    return home, guest


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], centres: np.ndarray, reach: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        home, guest = visits(unit_rows(_matrix(batch.column("vector"))), centres, reach)
        cells = [[h, *np.flatnonzero(g)] for h, g in zip(home, guest)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(home, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
            [*batch.schema.names, "home", "cells"],
        )


def linked(block: np.ndarray, rows: np.ndarray, cosine: float) -> np.ndarray:
    return rows @ block.T >= cosine


def roots_of(hits: np.ndarray, block_ids: np.ndarray, row_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and block the smallest id connected through ``hits``."""
    top = np.iinfo(np.int64).max
    rows, block = row_ids.copy(), block_ids.copy()
    r, c = np.nonzero(hits)
    while len(r):
        new_rows, new_block = rows.copy(), block.copy()
        np.minimum.at(new_rows, r, block[c])
        np.minimum.at(new_block, c, new_rows[r])
        if (new_rows == rows).all() and (new_block == block).all():
            break
        rows, block = new_rows, new_block
    return np.minimum(rows, top), block


def _compare(batches: Iterator[pa.RecordBatch], cosine: float, step: int = 512) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (cell, block, guest): a block is gathered, then compared with the rest."""
    key, ids, vectors, weights = None, [], [], []
    sealed = False
    names = ["node", "links", "root"]

    def out(nodes: np.ndarray, links: np.ndarray, roots: np.ndarray, some: np.ndarray) -> Iterator[pa.RecordBatch]:
        if some.any():
            arrays = (nodes[some], links[some], roots[some])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names)

    def against(own: tuple, rows: tuple, inside: bool) -> Iterator[pa.RecordBatch]:
        block_ids, block, block_weights = own
        row_ids, row_vectors, row_weights = rows
        for at in range(0, len(row_ids), step):
            cut = slice(at, at + step)
            hits = linked(block, row_vectors[cut], cosine)
            if inside:
                # Within a block every pair is seen from both ends; a row is no partner of its own.
                hits &= row_ids[cut][:, None] != block_ids[None, :]
            if not hits.any():
                continue
            row_roots, block_roots = roots_of(hits, block_ids, row_ids[cut])
            links = hits @ block_weights
            yield from out(row_ids[cut], links, row_roots, links > 0)
            if inside:
                # A row counts its links in its own step; the other steps only tell what it is connected with.
                yield from out(block_ids, np.zeros_like(block_weights), block_roots, block_roots < block_ids)
                continue
            links = hits.T @ row_weights[cut]
            yield from out(block_ids, links, block_roots, links > 0)

    def gathered() -> tuple:
        return np.concatenate(ids), unit_rows(np.concatenate(vectors)), np.concatenate(weights)

    own = None
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("node").to_numpy()
        place = np.stack([batch.column(x).to_numpy() for x in ("cell", "block", "size")], 1)
        guest = batch.column("guest").to_numpy(zero_copy_only=False)
        weight, matrix = batch.column("copies").to_numpy(), _matrix(batch.column("vector"))
        marks = np.concatenate([place, guest[:, None].astype(np.int64)], 1)
        edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1), len(marks)]
        for begin, end in zip(edges, edges[1:]):
            now, cut = tuple(place[begin]), slice(begin, end)
            if now != key:
                if ids and not sealed:
                    own = gathered()
                    yield from against(own, own, True)
                key, ids, vectors, weights, sealed, own = now, [], [], [], False, None
            if not guest[begin]:
                ids.append(node[cut])
                vectors.append(matrix[cut])
                weights.append(weight[cut])
                continue
            if not ids:
                continue
            if not sealed:
                own, sealed = gathered(), True
                yield from against(own, own, True)
            yield from against(own, (node[cut], unit_rows(matrix[cut]), weight[cut]), False)
    if ids and not sealed:
        own = gathered()
        yield from against(own, own, True)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _deal(vectors: DataFrame, cosine: float, sample_rows: int, max_cells: int, block_rows: int, cell_rows: int, size: int) -> DataFrame:
    """(node, links, root) of the vectors of one length; links to the root are real chains."""
    own = vectors.filter(F.col("size") == size)
    rows = own.count()
    picked = own.select("vector").orderBy(F.xxhash64("vector"), "node").limit(sample_rows)
    sample = unit_rows(np.array([x[0] for x in picked.collect()]))
    cells = max(1, min(max_cells, len(sample), math.ceil(rows / cell_rows)))
    centres = fit_centres(sample, cells)
    reach = math.sqrt(max(0.0, 2.0 - 2.0 * cosine))
    assigned = stage(
        own.mapInArrow(
            partial(_assign, centres=centres, reach=reach),
            "node bigint, copies bigint, size bigint, vector array<double>, home int, cells array<int>",
        ),
        "cells",
    )
    # So many blocks per cell; one row per cell, bounded by the number of cells.
    held = {r["home"]: r["n"] for r in assigned.groupBy("home").agg(F.count("*").alias("n")).collect()}
    blocks = F.create_map(*[F.lit(x) for c, n in held.items() for x in (int(c), math.ceil(n / block_rows))])
    placed = assigned.select("node", "copies", "size", "vector", "home", F.explode("cells").alias("cell")).filter(
        F.coalesce(F.element_at(blocks, F.col("cell")), F.lit(0)) > 0
    )
    count = F.element_at(blocks, F.col("cell"))
    mine = F.pmod(F.xxhash64("node"), count.cast("bigint"))
    native = placed.filter("home = cell")
    all_blocks = F.sequence(F.lit(0).cast("bigint"), count.cast("bigint") - 1)
    # At home a vector belongs to one block and is a guest of the later ones of its cell.
    at_home = native.select("*", F.explode(F.filter(all_blocks, lambda b: b >= mine)).alias("block"))
    at_home = at_home.withColumn("guest", F.col("block") != mine)
    away = placed.filter("home != cell").select("*", F.explode(all_blocks).alias("block"), F.lit(True).alias("guest"))
    tiles = at_home.unionByName(away).select("node", "copies", "size", "vector", F.col("cell").cast("bigint").alias("cell"), "block", "guest")
    dealt = tiles.repartition("cell", "block").sortWithinPartitions("cell", "block", "guest")
    return dealt.mapInArrow(partial(_compare, cosine=cosine), "node bigint, links bigint, root bigint")


def embedding_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, sample_rows: int = SAMPLE, max_cells: int = CELLS,
    block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings``."""
    rows = stage(
        embeddings.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        ),
        "vectors",
    )
    fine = rows.filter(_usable(F.col("vector")))
    distinct = stage(
        fine.groupBy("vector").agg(F.min("row").alias("node"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .select("node", "copies", F.size("vector").cast("bigint").alias("size"), "vector", "least"),
        "distinct-vectors",
    )
    sizes = [r[0] for r in distinct.groupBy("size").count().orderBy("size").select("size").collect()]
    parts = [
        _deal(distinct.drop("least"), cosine, sample_rows, max_cells, block_rows, cell_rows, size) for size in sizes
    ]
    none = embeddings.sparkSession.createDataFrame([], "node bigint, links bigint, root bigint")
    found = none
    for part in parts:
        found = found.unionByName(part)
    found = stage(found, "links")
    groups = connected_components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.select("node", "vector", "copies", "least").join(links, "node", "left").join(groups, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = nodes.join(least, "component").select(
        F.col("vector").alias("known"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    usable = rows.filter(_usable(F.col("vector"))).join(known, F.col("vector") == F.col("known"))
    rest = rows.filter(~F.coalesce(_usable(F.col("vector")), F.lit(False)))
    done = usable.select("vec_id", "n_links", F.col("component_id")).unionByName(
        rest.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    )
    return done.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def representatives(embeddings: DataFrame) -> DataFrame:
    """The ids that stay: one per group."""
    return embedding_duplicates(embeddings).filter("kept").select("vec_id").distinct()
