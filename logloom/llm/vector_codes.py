"""Product codes of vectors; the rounds skip distances by adaptive bounds per part.

Vectors become integers and are cut into equal parts; every part position has a codebook that is
refined by rounds of nearest-entry assignment and integer means. A part keeps, from round to round,
the entry it is assigned to with an upper bound of the distance, its ``b`` closest other entries with
lower bounds, and one outer bound under which no further entry lies. When entries move, bounds give way by
the distance moved. A part whose upper bound stays below all of them keeps its entry unseen; else
its distance is computed, then those of the listed entries whose bound it does not beat, and only
a part that does not beat the outer bound is compared with the whole codebook. ``b`` follows, per
part position, the number of bounds that the parts needed in the round before.

Bounds are rounded away from the truth when they are stored, and decide only with room to spare;
every other case is settled by integer distances, so codes equal those of plain rounds to the bit.

One pass turns vectors into integers and is written. The state of a round (integers and bounds) is one written table too; the round before it is dropped
when its follower is there. Sums and counts of entries combine per task and then by entry; the driver sees
codebooks and histograms of bounded size only.

Contract: rows whose vector is null or holds null or non-finite components are dropped. The most
frequent length that is a multiple of the number of parts (of equally frequent ones the least) is coded; vectors of another
length, and vectors with a component so large that an error might leave a long (2^17 and more at
64 components), keep their row with null code and errors, and take no part in codebooks. Of repeated vec_ids the lesser vector of integers comes
first among the rows that start the codebooks; null ids come last. With fewer rows than entries the
codebooks are shorter. A sum of errors beyond a long is null. Repeated rows give repeated rows; an empty table gives an empty result.
Columns besides ``vec_id``, ``embedding`` and ``label`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import broadcast_if_small, drop_path, stage, stage_at

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Listed entries per part: at the start, at least, and at most.
LISTED, LISTED_LEAST, LISTED_MOST = 8, 4, 32
# So many of the parts should be settled within their listed bounds.
SETTLED = 0.9
# Rows of a step: a distance table of a step is this times the entries.
STEP_ROWS = 4096
# Up to here sums of squares of doubles are exact integers.
EXACT = float(1 << 53)

_WHOLE = "vec_id bigint, label string, size bigint, most bigint, vector binary"
_STATE = "vec_id bigint, label string, vector binary, state binary"
_SUMS = "part int, slot int, n bigint, sums array<bigint>"


class State:
    """Bounds of the parts of some vectors, as stored per vector and part: entry, upper, outer, b entries, b lower bounds."""

    def __init__(self, size: int, listed: int):
        self.entry = np.zeros(size, np.int64)
        self.upper = np.full(size, np.inf)
        self.outer = np.zeros(size)
        self.ids = np.zeros((size, listed), np.int64)
        # An unused place of the list has an infinite bound.
        self.low = np.full((size, listed), np.inf)

    @staticmethod
    def kind(listed: int) -> np.dtype:
        return np.dtype([("entry", "<u2"), ("upper", "<f4"), ("outer", "<f4"), ("ids", "<u2", (listed,)), ("low", "<f4", (listed,))])

    def packed(self) -> np.ndarray:
        out = np.zeros(len(self.entry), self.kind(self.ids.shape[1]))
        out["entry"], out["ids"] = self.entry, self.ids
        out["upper"] = np.nextafter(self.upper.astype(np.float32), np.float32(np.inf))
        out["outer"] = np.nextafter(self.outer.astype(np.float32), np.float32(-np.inf))
        low = self.low.astype(np.float32)
        out["low"] = np.where(np.isinf(low), low, np.nextafter(low, np.float32(-np.inf)))
        return out

    @classmethod
    def unpacked(cls, rows: np.ndarray) -> State:
        state = cls(0, 0)
        state.entry, state.ids = rows["entry"].astype(np.int64), rows["ids"].astype(np.int64)
        state.upper, state.outer, state.low = (rows[x].astype(np.float64) for x in ("upper", "outer", "low"))
        return state

    def resized(self, listed: int) -> None:
        """Lists of ``listed`` places: what falls off is covered by the outer bound."""
        size, held = self.low.shape
        if listed < held:
            order = np.argsort(self.low, axis=1, kind="stable")
            self.low, self.ids = np.take_along_axis(self.low, order, 1), np.take_along_axis(self.ids, order, 1)
            self.outer = np.minimum(self.outer, self.low[:, listed])
            self.low, self.ids = self.low[:, :listed].copy(), self.ids[:, :listed].copy()
        elif listed > held:
            self.low = np.concatenate([self.low, np.full((size, listed - held), np.inf)], 1)
            self.ids = np.concatenate([self.ids, np.zeros((size, listed - held), np.int64)], 1)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, as exact integers.

    Doubles are exact as long as no sum can leave 2^53; beyond that integers are used throughout.
    """
    most = 2.0 * max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if points.shape[1] * most * most < EXACT:
        a, c = points.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2.0 * (a @ c.T) + (c * c).sum(1)[None, :]
    out = np.zeros((len(points), len(entries)), np.int64)
    for j in range(points.shape[1]):
        gap = points[:, j, None] - entries[None, :, j]
        out += gap * gap
    return out


def squared_pairs(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances row by row, in integers."""
    gap = points - entries
    return (gap * gap).sum(1)


def search_all(points: np.ndarray, entries: np.ndarray, listed: int) -> State:
    """Entries and bounds by all distances; of equal distances the lower index wins."""
    state, count = State(len(points), listed), len(entries)
    if not len(points):
        return state
    apart = squared(points, entries)
    rows = np.arange(len(points))
    state.entry = apart.argmin(1)
    state.upper = np.sqrt(apart[rows, state.entry].astype(np.float64))
    far = np.sqrt(apart.astype(np.float64))
    far[rows, state.entry] = np.inf
    held = min(listed, count - 1)
    # The closest ``held`` others are listed; the next one is the outer bound.
    cut = min(held + 1, count)
    near = np.argpartition(far, cut - 1, 1)[:, :cut]
    order = np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    values = np.take_along_axis(far, near, 1)
    state.ids[:, :held], state.low[:, :held] = near[:, :held], values[:, :held]
    state.outer = values[:, held] if held < cut else np.full(len(points), np.inf)
    return state


def advance(points: np.ndarray, state: State, entries: np.ndarray, moved: np.ndarray, listed: int) -> np.ndarray:
    """Bring ``state`` from the entries before to ``entries``, which have ``moved`` so far.

    Returns, per point, how many listed bounds were looked at; one more than the list is long where
    all entries were compared.
    """
    needed = np.zeros(len(points), np.int64)
    if not len(points):
        state.resized(listed)
        return needed
    # A little more than the truth each time, for the rounding of these sums.
    room = 1.0 + 1e-12
    state.upper = (state.upper + moved[state.entry]) * room
    state.low = (state.low - moved[state.ids]) / room
    state.outer = (state.outer - moved.max(initial=0.0)) / room
    least = np.minimum(state.low.min(1, initial=np.inf), state.outer)
    open_rows = np.flatnonzero(~(state.upper < least))
    own = squared_pairs(points[open_rows], entries[state.entry[open_rows]])
    state.upper[open_rows] = np.sqrt(own.astype(np.float64)) * room
    still = ~(state.upper[open_rows] < least[open_rows])
    open_rows, own = open_rows[still], own[still]
    beyond = ~(state.upper[open_rows] < state.outer[open_rows])
    whole = open_rows[beyond]
    rows, own = open_rows[~beyond], own[~beyond]
    # Listed entries that may be as near: settled by integers.
    asked = ~(state.low[rows] > state.upper[rows][:, None])
    needed[rows] = asked.sum(1)
    r, c = np.nonzero(asked)
    if len(r):
        ids = state.ids[rows[r], c]
        apart = squared_pairs(points[rows[r]], entries[ids])
        state.low[rows[r], c] = np.sqrt(apart.astype(np.float64)) / room
        # The least (distance, index) of every row, its own entry included.
        order = np.lexsort((ids, apart, r))
        first = order[np.flatnonzero(np.diff(r[order], prepend=-1))]
        at = r[first]
        held = state.entry[rows[at]]
        wins = (apart[first] < own[at]) | ((apart[first] == own[at]) & (ids[first] < held))
        first, at, held = first[wins], at[wins], held[wins]
        # The entry before takes the place of the new one in the list.
        line, place = rows[at], c[first]
        state.ids[line, place], state.low[line, place] = held, np.sqrt(own[at].astype(np.float64)) / room
        state.entry[line], state.upper[line] = ids[first], np.sqrt(apart[first].astype(np.float64)) * room
    needed[whole] = state.low.shape[1] + 1
    state.resized(listed)
    fresh = search_all(points[whole], entries, listed)
    for name in ("entry", "upper", "outer", "ids", "low"):
        getattr(state, name)[whole] = getattr(fresh, name)
    return needed


def next_listed(needed: dict[int, int], listed: int) -> int:
    """How long the lists should be, from the histogram of bounds that were needed."""
    total = sum(needed.values())
    if not total:
        return listed
    within = 0
    for size in range(listed + 1):
        within += needed.get(size, 0)
        if within >= SETTLED * total:
            return max(LISTED_LEAST, size)
    return min(LISTED_MOST, 2 * listed)


def _prepare(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Kept vectors as integers: size, largest magnitude, and bytes that sort like the vectors.

    Where a vector can't be coded at all the last two are null.
    """
    for whole in batches:
        vectors = whole.column("vector")
        batch = whole.filter(vectors.is_valid())
        vectors = batch.column("vector")
        flat = vectors.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
        bad = ~np.isfinite(values) | flat.is_null().to_numpy(zero_copy_only=False)
        ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.append(0, ends[:-1])
        before = np.append(0, np.cumsum(bad))
        kept = np.flatnonzero(before[ends] == before[starts])
        rows = []
        for i in kept:
            own, size = values[starts[i] : ends[i]], int(ends[i] - starts[i])
            # No two such vectors are 2^31 apart, so their squared distance is a long.
            top = np.abs(own).max() * SCALE if size and size % parts == 0 else np.inf
            if not top * np.sqrt(size) < 2.0**30:
                rows.append((size, None, None))
                continue
            integers = np.floor(own * SCALE).astype(np.int64)
            rows.append((size, int(np.abs(integers).max()), (integers + 2**31).astype(">u4").tobytes()))
        columns = zip(*rows) if rows else ((), (), ())
        kinds = (pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(x).take(pa.array(kept)) for x in ("vec_id", "label")] + [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["vec_id", "label", "size", "most", "vector"],
        )


def _integers(vectors: list[bytes]) -> np.ndarray:
    """Prepared vectors of one length, (rows, length)."""
    return np.frombuffer(b"".join(vectors), ">u4").astype(np.int64).reshape(len(vectors), -1) - 2**31


def _cut(whole: np.ndarray, parts: int) -> list[np.ndarray]:
    wide = whole.shape[1] // parts
    return [whole[:, p * wide : (p + 1) * wide] for p in range(parts)]


def _binaries(rows: np.ndarray) -> pa.Array:
    """The rows of a two-dimensional array as binary values."""
    raw = np.ascontiguousarray(rows)
    wide = raw.dtype.itemsize * (raw.shape[1] if raw.ndim == 2 else 1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(wide), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, kind: np.dtype, rows: int) -> np.ndarray:
    """Binary values of equal length as a two-dimensional array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _packed(states: list[State]) -> pa.Array:
    rows = [state.packed() for state in states]
    return _binaries(np.concatenate([x.view(np.uint8).reshape(len(x), -1) for x in rows], 1))


def _states(column: pa.Array, listed: list[int], rows: int) -> list[State]:
    raw = _matrix(column, np.dtype(np.uint8), rows)
    states, at = [], 0
    for size in listed:
        kind = State.kind(size)
        states.append(State.unpacked(np.ascontiguousarray(raw[:, at : at + kind.itemsize]).view(kind).reshape(rows)))
        at += kind.itemsize
    return states


def _steps(batches: Iterator[pa.RecordBatch], rows: int = STEP_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _start(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], listed: list[int], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    for batch in _steps(batches):
        whole = _integers(batch.column("vector").to_pylist())
        states = [search_all(points, book, size) for points, book, size in zip(_cut(whole, len(books)), books, listed)]
        columns = [batch.column("vec_id"), batch.column("label"), _binaries(whole.astype(kind)), _packed(states)]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "state"])


def _round(
    batches: Iterator[pa.RecordBatch], books: list[np.ndarray], moved: list[np.ndarray], before: list[int], listed: list[int], kind: np.dtype
) -> Iterator[pa.RecordBatch]:
    for batch in _steps(batches):
        whole = _matrix(batch.column("vector"), kind, batch.num_rows).astype(np.int64)
        states = _states(batch.column("state"), before, batch.num_rows)
        needed = [advance(*x) for x in zip(_cut(whole, len(books)), states, books, moved, listed)]
        columns = [batch.column("vec_id"), batch.column("label"), batch.column("vector"), _packed(states)]
        seen = _binaries(np.stack(needed, 1).astype("<u2"))
        yield pa.RecordBatch.from_arrays([*columns, seen], ["vec_id", "label", "vector", "state", "needed"])


def _sum_task(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], listed: list[int], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """(part, slot, n, sums) of a task: entries first, then, from slot len(book) on, the bounds needed."""
    sums = [np.zeros_like(x) for x in books]
    counts = [np.zeros(len(x), np.int64) for x in books]
    needed = [np.zeros(size + 2, np.int64) for size in listed]
    for batch in _steps(batches):
        whole = _matrix(batch.column("vector"), kind, batch.num_rows).astype(np.int64)
        states = _states(batch.column("state"), listed, batch.num_rows)
        seen = _matrix(batch.column("needed"), np.dtype("<u2"), batch.num_rows) if "needed" in batch.schema.names else None
        for p, (points, state) in enumerate(zip(_cut(whole, len(books)), states)):
            order = np.argsort(state.entry, kind="stable")
            starts = np.flatnonzero(np.diff(state.entry[order], prepend=-1))
            if len(starts):
                sums[p][state.entry[order][starts]] += np.add.reduceat(points[order], starts)
            counts[p] += np.bincount(state.entry, minlength=len(books[p]))
            if seen is not None:
                needed[p] += np.bincount(np.minimum(seen[:, p], listed[p] + 1), minlength=listed[p] + 2)
    rows = []
    for p, book in enumerate(books):
        rows += [(p, slot, int(n), sums[p][slot].tolist()) for slot, n in enumerate(counts[p]) if n]
        rows += [(p, len(book) + z, int(n), [0] * book.shape[1]) for z, n in enumerate(needed[p]) if n]
    columns = zip(*rows) if rows else ((),) * 4
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "slot", "n", "sums"])


def _finish(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], listed: list[int], kind: np.dtype) -> Iterator[pa.RecordBatch]:
    for batch in _steps(batches):
        whole = _matrix(batch.column("vector"), kind, batch.num_rows).astype(np.int64)
        states = _states(batch.column("state"), listed, batch.num_rows)
        error = np.zeros(batch.num_rows, np.int64)
        for points, state, book in zip(_cut(whole, len(books)), states, books):
            error += squared_pairs(points, book[state.entry])
        codes = ["".join(f"{x:02x}" for x in row) for row in np.stack([s.entry for s in states], 1).tolist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(error)],
            ["vec_id", "label", "code", "error"],
        )


def update(book: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Entries replaced by the floored means of their parts; unused ones stay."""
    out = book.copy()
    for slot, (n, total) in sums.items():
        out[slot] = [int(x) // n for x in total]
    return out


def _totals(rows: DataFrame, books: list[np.ndarray], listed: list[int], kind: np.dtype) -> tuple[list[dict], list[dict]]:
    """Sums per entry and the histogram of needed bounds, per part; at most entries plus bounds rows per part."""
    wide = books[0].shape[1]
    partial_sums = rows.mapInArrow(partial(_sum_task, books=books, listed=listed, kind=kind), _SUMS)
    columns = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(wide)]
    found = partial_sums.groupBy("part", "slot").agg(F.sum("n").alias("n"), *columns).collect()
    sums: list[dict] = [{} for _ in books]
    needed: list[dict] = [{} for _ in books]
    for r in found:
        size = len(books[r["part"]])
        if r["slot"] < size:
            sums[r["part"]][r["slot"]] = (r["n"], [r[f"s{i}"] for i in range(wide)])
        else:
            needed[r["part"]][r["slot"] - size] = r["n"]
    return sums, needed


def digest_of(books: list[np.ndarray]) -> str:
    """Lowercase hex digest of all entries' components in order."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def train_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) per kept vector, and the codebooks; code is null where a vector can't be coded."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), vector.alias("vector"))
    rows, ready = stage_at(rows.mapInArrow(partial(_prepare, parts=parts), _WHOLE), "integers")
    # One row: the length that is coded.
    sizes = rows.filter("most IS NOT NULL").groupBy("size").agg(F.count("*").alias("n"), F.max("most").alias("most"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    null_code = F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")
    if common is None:
        return rows.select("vec_id", "label", *null_code), []
    own = rows.filter((F.col("size") == common["size"]) & F.col("most").isNotNull())
    others = rows.filter((F.col("size") != common["size"]) | F.col("most").isNull()).select("vec_id", "label", *null_code)
    first = own.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    books = [x.copy() for x in _cut(_integers([bytes(r["vector"]) for r in first]), parts)]
    # The least width that holds all components.
    kind = np.dtype("<i2" if common["most"] < 1 << 15 else "<i4")
    listed = [LISTED] * parts
    held, path = stage_at(own.select("vec_id", "label", "vector").mapInArrow(partial(_start, books=books, listed=listed, kind=kind), _STATE), "codes")
    others = stage(others, "not-coded")
    drop_path(embeddings.sparkSession, ready)
    for _ in range(rounds):
        sums, needed = _totals(held, books, listed, kind)
        fresh = [update(book, s) for book, s in zip(books, sums)]
        moved = [np.sqrt(squared_pairs(a, b).astype(np.float64)) for a, b in zip(fresh, books)]
        wanted = [next_listed(n, size) for n, size in zip(needed, listed)]
        step = partial(_round, books=fresh, moved=moved, before=listed, listed=wanted, kind=kind)
        after, written = stage_at(held.mapInArrow(step, _STATE + ", needed binary"), "codes")
        drop_path(embeddings.sparkSession, path)
        held, path, books, listed = after, written, fresh, wanted
    done = held.mapInArrow(partial(_finish, books=books, listed=listed, kind=kind), "vec_id bigint, label string, code string, error bigint")
    return done.unionByName(others), books


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per kept vector."""
    done, books = train_codes(embeddings, parts, entries, rounds)
    done = stage(done, "coded")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = F.when(total <= F.lit(2**63 - 1).cast("decimal(38,0)"), total.cast("bigint"))
    labels = done.groupBy("label").agg(fits.alias("label_error")).withColumnRenamed("label", "known")
    return done.join(broadcast_if_small(labels), F.col("label").eqNullSafe(F.col("known")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256")
    )
