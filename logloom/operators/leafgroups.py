"""Leaders and groups of the signatures of one leaf, found in one task.

Tokens become numbers, a row per signature. Leaders that cover many are found by comparing them with every row; those that
are left are compared only where they share a pair of tokens (see ``templates``), by sorted keys of such pairs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tasks get the functions below with their job, so workers need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Signatures that are settled one by one before the others are compared with their leaders, and the share of the open ones
# that these must cover to go on so.
FRONT, WORTH = 64, 0.25
# Cells of two rows that are compared at once.
CHUNK_CELLS = 4_000_000


def numbered(signatures: pa.Array, wildcard: str) -> np.ndarray:
    """Tokens as numbers, -1 for the wildcard; all signatures have as many tokens."""
    words = pc.split_pattern(signatures, " ").flatten().dictionary_encode()
    ids = words.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    wild = pc.index(words.dictionary, wildcard).as_py()
    if wild >= 0:
        ids[ids == wild] = -1
    return ids.reshape(len(signatures), -1)


def _equal(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    left = ids[a]
    return ((left == ids[b]) & (left >= 0)).sum(axis=1)


def _against(ids: np.ndarray, rows: np.ndarray, leader: int) -> np.ndarray:
    """Equal tokens of ``rows`` and one leader."""
    own = ids[leader]
    return ((ids[rows] == own) & (own >= 0)).sum(axis=1)


def _candidates(ids: np.ndarray, left: np.ndarray, right: np.ndarray, need: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``left`` and ``right`` that share what ``need`` equal tokens imply; some come more than once."""
    width = ids.shape[1]
    base = np.int64(ids.max()) + 1
    most = max(1, CHUNK_CELLS // max(1, width))
    places = [(i, None) for i in range(width)] if need == 1 else [(i, j) for i in range(width) for j in range(i + need - 1, width, need - 1)]
    for i, j in places:

        def keys(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            one = ids[rows, i]
            two = one if j is None else ids[rows, j]
            known = np.flatnonzero((one >= 0) & (two >= 0))
            return rows[known], one[known] * base + two[known]

        (a, a_key), (b, b_key) = keys(left), keys(right)
        order = np.argsort(b_key, kind="stable")
        b, b_key = b[order], b_key[order]
        low = np.searchsorted(b_key, a_key, "left")
        counts = np.searchsorted(b_key, a_key, "right") - low
        ends = np.cumsum(counts)
        start = 0
        while start < len(a):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
            some = counts[start:stop]
            total = int(some.sum())
            if total:
                within = np.arange(total) - np.repeat(np.cumsum(some) - some, some)
                yield np.repeat(a[start:stop], some), b[np.repeat(low[start:stop], some) + within]
            start = stop


def _similar(ids: np.ndarray, left: np.ndarray, right: np.ndarray, need: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of left, row of right, equal tokens) of all similar pairs; of the ``same`` rows, the later one is left."""
    found, most = [], max(1, CHUNK_CELLS // max(1, ids.shape[1]))
    for a, b in _candidates(ids, left, right, need):
        if same:
            later = a > b
            a, b = a[later], b[later]
        for start in range(0, len(a), most):
            one, two = a[start : start + most], b[start : start + most]
            equal = _equal(ids, one, two)
            hit = np.flatnonzero(equal >= need)
            if len(hit):
                found.append(np.stack([one[hit], two[hit], equal[hit]]))
    if not found:
        return (np.empty(0, np.intp),) * 3
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def leader_of(ids: np.ndarray, need: int) -> np.ndarray:
    """Row of the leader of every row, rows being in order of appearance.

    A leader is similar to no earlier leader; ``need`` tokens must be equal. A row goes to the leader with which it has most
    equal tokens, of several to the earliest, and a leader to itself.
    """
    rows = len(ids)
    fixed = (ids == ids[0]).all(axis=0) & (ids[0] >= 0)
    need -= int(fixed.sum())
    ids = np.ascontiguousarray(ids[:, ~fixed])
    if need <= 0:
        return np.zeros(rows, np.intp)
    if need > ids.shape[1]:
        return np.arange(rows)
    best, most = np.full(rows, -1, np.intp), np.zeros(rows, np.intp)
    everyone, opened = np.arange(rows), np.arange(rows)
    leaders: list[int] = []
    covered = np.zeros(rows, bool)
    going = True
    while going and len(opened):
        front = opened[:FRONT]
        for row in front:
            if covered[row]:
                continue
            leaders.append(int(row))
            equal = _against(ids, everyone, row)
            better = (equal >= need) & (equal > most)
            best[better], most[better] = row, equal[better]
            covered |= equal >= need
            covered[row] = True
        left = opened[~covered[opened]]
        going = len(opened) - len(left) - len(front) >= WORTH * (len(opened) - len(front))
        opened = left
    if len(opened):
        later, earlier, equal = _similar(ids, opened, opened, need, True)
        leads = np.zeros(rows, bool)
        leads[opened] = True
        order = np.argsort(later, kind="stable")
        for row, other in zip(later[order].tolist(), earlier[order].tolist()):
            if leads[other]:
                leads[row] = False
        new = np.flatnonzero(leads)
        gone = everyone[covered]
        a, b, same = _similar(ids, gone, new, need, False)
        a, b = np.concatenate([a, later, earlier]), np.concatenate([b, earlier, later])
        same = np.concatenate([same, equal, equal])
        kept = leads[b]
        a, b, same = a[kept], b[kept], same[kept]
        order = np.lexsort((b, -same, a))
        a, b, same = a[order], b[order], same[order]
        first = np.flatnonzero(np.diff(a, prepend=-1) > 0)
        a, b, same = a[first], b[first], same[first]
        better = same > most[a]
        best[a[better]] = b[better]
        leaders.extend(new.tolist())
    best[leaders] = leaders
    return best


def needed(n_tokens: int, sim_th: float) -> int:
    """Tokens that must be equal for a share of at least ``sim_th``; more than there are if none suffice."""
    return next((c for c in range(n_tokens + 1) if c / max(n_tokens, 1) >= sim_th), n_tokens + 1)


def grouped_by_leaf(rows: DataFrame, buckets: int, sim_th: float, wildcard: str) -> DataFrame:
    """``rows`` (n_tokens, heads, seen_at, signature and others) with leader_seen, and ``leads`` for leaders.

    A leaf lies in one of the ``buckets``, which are dealt to the tasks; its signatures are a group of their own there.
    """
    columns = rows.columns

    def settle(table: pa.Table) -> pa.Table:
        leaf = table["leaf"].combine_chunks().dictionary_encode()
        table = table.drop_columns(["bucket", "leaf"]).append_column("leaf", leaf.indices)
        order = pc.sort_indices(table, sort_keys=[(name, "ascending") for name in ("n_tokens", "leaf", "seen_at", "signature")])
        table = table.take(order).combine_chunks()
        size, leaf = table["n_tokens"].to_numpy(), table["leaf"].to_numpy()
        first = np.flatnonzero(np.r_[True, (size[1:] != size[:-1]) | (leaf[1:] != leaf[:-1])])
        best = np.arange(len(table))
        signatures = table["signature"].combine_chunks()
        for start, stop in zip(first.tolist(), [*first[1:].tolist(), len(table)]):
            if stop - start > 1:
                ids = numbered(signatures.slice(start, stop - start), wildcard)
                best[start:stop] = start + leader_of(ids, needed(ids.shape[1], sim_th))
        table = table.select(columns).append_column("leader_seen", table["seen_at"].take(pa.array(best)))
        return table.append_column("leads", pa.array(best == np.arange(len(best))))

    kinds = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema]
    schema = ", ".join([*kinds, f"leader_seen {rows.schema['seen_at'].dataType.simpleString()}", "leads boolean"])
    # Tokens hold no blank, so the joined heads are as good as the heads.
    keyed = rows.withColumn("leaf", F.array_join("heads", " "))
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("n_tokens", "leaf"), F.lit(buckets)))
    return keyed.groupBy("bucket").applyInArrow(settle, schema)
