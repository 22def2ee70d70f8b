"""Product codes against plain rounds of integer assignment and means."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm.vector_codes import State, advance, next_listed, search_all, squared, squared_pairs, train_codes, vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, known string, vector int"


def brute(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label) and the digest, with Python integers."""
    kept = sorted([(i, [math.floor(1024 * x) for x in v], x) for i, v, x in rows], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [v for _, v, _ in kept]
    wide = len(whole[0]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for v in whole] for p in range(parts)]
    books = [[list(x) for x in c[:entries]] for c in cut]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups: dict = {}
            for point in cut[p]:
                groups.setdefault(nearest(point, books[p])[1], []).append(point)
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    found = []
    for n, (vec_id, _, label) in enumerate(kept):
        best = [nearest(cut[p][n], books[p]) for p in range(parts)]
        found.append((vec_id, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    joined = ",".join(str(x) for book in books for entry in book for x in entry)
    return found, hashlib.sha256(joined.encode()).hexdigest()


def check(spark, rows, others=(), **how):
    df = spark.createDataFrame([(*r, "c", "k", 1) for r in [*rows, *others]], SCHEMA)
    found = vector_codes(df.repartition(3), **how).collect()
    want, digest = brute(rows, **how)
    totals: dict = {}
    for _, _, error, label in want:
        totals[label] = totals.get(label, 0) + error
    expected = [(i, code, error, totals[label], digest) for i, code, error, label in want]
    got = [tuple(r) for r in found if r.code is not None]
    assert sorted(got, key=str) == sorted(expected, key=str)
    return [r for r in found if r.code is None]


def test_clusters(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    vectors = centres[rng.integers(0, 30, 900)] + rng.normal(scale=0.1, size=(900, 16))
    rows = [(int(i), v.tolist(), None if i % 11 == 0 else int(i) % 3) for i, v in zip(rng.permutation(900), vectors)]
    assert check(spark, rows, entries=40) == []


def test_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    # Few distinct values: equal distances everywhere, equal entries, unused entries.
    rows = [(i // 2, (rng.integers(-2, 3, 8) / 1024).tolist(), 1) for i in range(500)]
    rows += [rows[7], rows[7], (None, rows[9][1], None), (None, [0.5] * 8, 2)]
    check(spark, rows, entries=64)


def test_large_components_and_what_is_left_out(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(0, 5)).tolist(), 0) for i in range(200)]
    others = [(900, None, 0), (901, [1.0, None] * 4, 0), (902, [math.nan] * 8, 0), (903, [math.inf] * 8, 0)]
    null_codes = [(910, [1.0] * 4, 0), (911, [], 0), (912, [1.0] * 7, 0), (913, [1e30] * 8, 9)]
    left = check(spark, rows, others + null_codes, entries=32)
    assert sorted(r.vec_id for r in left) == [910, 911, 912, 913]
    assert all(r.error is None for r in left)
    assert {r.vec_id: r.label_error for r in left}[913] is None


def test_few_rows_and_none(spark):
    check(spark, [(3, [0.1, 0.2, 0.3, 0.4], 1), (1, [-0.1, 0.2, 0.9, 0.4], 1)])
    check(spark, [(3, [0.1, 0.2, 0.3, 0.4], None)])
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes(empty).collect() == [] and train_codes(empty)[1] == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 3, 50, 1 << 22]))
def test_rounds_by_bounds_equal_all_distances(seed, spread):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (60, 3))
    book = rng.integers(-spread, spread + 1, (int(rng.integers(1, 40)), 3))
    listed = int(rng.integers(4, 9))
    state = search_all(points, book, listed)
    for _ in range(5):
        after = book + rng.integers(-max(1, spread // 8), max(1, spread // 8) + 1, book.shape) * rng.integers(0, 2, (len(book), 1))
        moved = np.sqrt(squared_pairs(after, book).astype(float))
        # As between rounds: stored and read again.
        state = State.unpacked(state.packed())
        wanted = int(rng.integers(4, 9))
        needed = advance(points, state, after, moved, wanted)
        book, listed = after, wanted
        apart = squared(points, book)
        assert (state.entry == apart.argmin(1)).all()
        true = np.sqrt(apart.astype(float))
        rows = np.arange(len(points))
        assert (state.upper >= true[rows, state.entry]).all() and state.low.shape[1] == wanted and (needed >= 0).all()
        for i in rows:
            seen = {int(k): low for k, low in zip(state.ids[i], state.low[i]) if np.isfinite(low)}
            assert all(low <= true[i, k] + 1e-9 for k, low in seen.items())
            assert all(true[i, k] + 1e-9 >= state.outer[i] for k in range(len(book)) if k not in seen and k != state.entry[i])


def test_bounds_spare_distances_when_little_moves():
    rng = np.random.default_rng(1)
    book = rng.integers(-10_000, 10_000, (200, 4))
    points = book[rng.integers(0, 200, 500)] + rng.integers(-50, 50, (500, 4))
    state = search_all(points, book, 8)
    after = book + rng.integers(-20, 20, book.shape)
    needed = advance(points, state, after, np.sqrt(squared_pairs(after, book).astype(float)), 8)
    assert (needed == 0).mean() > 0.9


def test_lists_follow_what_was_needed():
    assert next_listed({0: 95, 8: 5}, 8) == 4
    assert next_listed({6: 100}, 8) == 6
    assert next_listed({9: 100}, 8) == 16
    assert next_listed({33: 100}, 32) == 32
    assert next_listed({}, 8) == 8


@pytest.mark.parametrize("spread", [100, 1 << 27])
def test_distances_are_exact_integers(spread):
    rng = np.random.default_rng(0)
    a, b = rng.integers(-spread, spread, (20, 4)), rng.integers(-spread, spread, (9, 4))
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e)) for e in b] for p in a]
    assert [[int(x) for x in row] for row in squared(a, b)] == want
