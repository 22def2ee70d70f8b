from __future__ import annotations

import numpy as np
import pytest

from logloom.operators import counts as C
from logloom.operators import profile as P
from logloom.operators import selection as S
from logloom.session import stage


def _counts(spark, matrix):
    rows = [
        (f"e{i}", f"E{j + 1}", int(v)) for i, line in enumerate(matrix) for j, v in enumerate(line) if v
    ]
    return stage(spark.createDataFrame(rows, "entity_id string, event_id string, n bigint"), "test-counts")


def _events(spark, width):
    return spark.createDataFrame([(f"E{i + 1}",) for i in range(width)], "event_id string")


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(3)
    matrix = rng.poisson(0.8, (400, 12))
    matrix[:, 3] = matrix[:, 1] * 2
    matrix[:, 5] = np.maximum(matrix[:, 4] + (rng.random(400) < 0.05), 0)
    matrix[:, 7] = 2
    matrix[:, 9] = 0
    matrix[:, 10] = 0
    matrix[0, 10] = 1
    return matrix


def test_variance_and_correlation_equal_the_dense_matrix(spark, dense):
    counts, events = _counts(spark, dense), _events(spark, dense.shape[1])
    variance = {r.event_id: r.variance for r in P.event_variance(counts, events).collect()}
    for j in range(dense.shape[1]):
        assert variance[f"E{j + 1}"] == pytest.approx(dense[:, j].var(ddof=1), abs=1e-12)
    with np.errstate(all="ignore"):
        expected = np.corrcoef(dense.T)
    rows = P.event_correlation(counts, events).collect()
    assert len(rows) == 12 * 11 // 2
    for r in rows:
        want = expected[r.event_no_a - 1, r.event_no_b - 1]
        assert (r.r is None) if np.isnan(want) else r.r == pytest.approx(want, abs=1e-12)


def test_products_in_small_blocks(spark, dense):
    counts = _counts(spark, dense)
    want = {(r.no_a, r.no_b): r.xy for r in P.event_products(counts).collect()}
    assert {(r.no_a, r.no_b): r.xy for r in P.event_products(counts, block_rows=3, tile=2).collect()} == want


def test_task_function_needs_no_package_on_the_executors(spark, dense, tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    df = P.event_products(_counts(spark, dense))
    del df
    captured = {}

    class Probe:
        def groupBy(self, *a):
            return self

        agg = select = groupBy

        def mapInArrow(self, fn, schema):
            captured["fn"] = fn
            return self

    P.event_products(Probe())
    (tmp_path / "fn.bin").write_bytes(cloudpickle.dumps(captured["fn"]))
    code = f"import pickle; pickle.load(open({str(tmp_path / 'fn.bin')!r}, 'rb'))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)


def test_huge_counts_do_not_overflow(spark):
    big = 300_000_000_000
    counts = _counts(spark, [[big, big + 2], [1, 2], [big // 2, 7]])
    matrix = np.array([[big, big + 2], [1, 2], [big // 2, 7]], dtype=float)
    variance = {r.event_id: r.variance for r in P.event_variance(counts).collect()}
    assert variance["E1"] == pytest.approx(matrix[:, 0].var(ddof=1), rel=1e-9)
    (row,) = P.event_correlation(counts).collect()
    assert row.r == pytest.approx(np.corrcoef(matrix.T)[0, 1], rel=1e-9)


@pytest.mark.parametrize("base", [10**9, 10**11])
def test_noise_on_large_counts_is_kept(spark, base):
    noise = np.random.default_rng(3).integers(0, 1000, (60, 4))
    noise[:, 3] = noise[:, 0] + noise[:, 1] // 3
    want = np.corrcoef(noise.T.astype(float))
    for r in P.event_correlation(_counts(spark, (base + noise).tolist())).collect():
        assert r.r == pytest.approx(want[r.event_no_a - 1, r.event_no_b - 1], abs=1e-9)


def test_one_entity_has_no_variance(spark):
    counts = _counts(spark, [[1, 2]])
    assert {r.variance for r in P.event_variance(counts).collect()} == {None}
    assert S.select_by_variance(counts).count() == 2


def test_correlation_drop_counts_dropped_columns(spark):
    rng = np.random.default_rng(1)
    a = rng.poisson(50, 3000)
    b = a + rng.poisson(3.5, 3000)
    c = b + rng.poisson(4.5, 3000)
    r = np.corrcoef([a, b, c])
    assert r[0, 1] > 0.95 and r[1, 2] > 0.95 and r[0, 2] < 0.95
    counts = _counts(spark, np.stack([a, b, c], axis=1))
    kept = S.select_features(counts, None, 0.95)
    assert [x.event_id for x in kept.collect()] == ["E1"]
    pairs = P.correlated_pairs(P.event_correlation(counts), symmetric=True)
    assert {(x.event_a, x.event_b) for x in pairs.collect()} == {
        ("E1", "E2"), ("E2", "E1"), ("E2", "E3"), ("E3", "E2"), *((p, q) for p, q in (("E1", "E3"), ("E3", "E1")) if r[0, 2] > 0.9)
    }


def test_perfect_pairs_are_not_listed(spark):
    counts = _counts(spark, [[1, 2], [2, 4], [5, 10]])
    assert P.correlated_pairs(P.event_correlation(counts)).isEmpty()


def test_matrix_keeps_entities_without_columns(spark):
    counts = _counts(spark, [[1, 0, 2], [0, 0, 3]])
    matrix = C.with_total(C.occurrence_matrix(counts, ["E1", "E2"]))
    rows = {r.entity_id: (r.E1, r.E2, r.total_events) for r in matrix.collect()}
    assert rows == {"e0": (1, 0, 1), "e1": (0, 0, 0)}
    assert [tuple(r) for r in C.dropped_events(counts, ["E1", "E2"]).collect()] == [("E3", 5)]
    assert [tuple(r) for r in C.unpivot_matrix(matrix).collect()] == [("e0", "E1", 1)]


def test_event_columns_are_ordered_by_number():
    assert C.event_columns(["E10", "label", "E2", "Extra", "E", "total_events", "E1"]) == ["E1", "E2", "E10"]


def test_empty_counts(spark):
    counts = spark.createDataFrame([], "entity_id string, event_id string, n bigint")
    (row,) = C.matrix_density(counts).collect()
    assert (row.entities, row.events, row.nonzero, row.density_pct) == (0, 0, 0, None)
    assert P.event_correlation(counts).isEmpty()
    assert P.top_events(counts).isEmpty()


def test_median_and_ratio_edges(spark):
    totals = spark.createDataFrame([("a", 1), ("b", 4), ("c", 2), ("d", 9)], "entity_id string, total_events bigint")
    (row,) = C.total_summary(totals).collect()
    assert (row.mean_events, row.min_events, row.max_events, row.median_events) == (4.0, 1, 9, 3.0)
    one = spark.createDataFrame([("a", "Normal")], "entity_id string, label string")
    assert P.class_ratio(one).first().ratio is None
    assert P.majority_ratio(one).first().ratio is None


def test_strong_correlations_are_those_of_the_matrix(spark):
    rng = np.random.default_rng(9)
    base = rng.poisson(3, (200, 6))
    # Complements that never meet, copies, a constant, a rare and an absent event.
    half = rng.integers(0, 2, 200)
    matrix = np.column_stack([base, half * 5, (1 - half) * 3, base[:, 0] * 2, np.full(200, 4), np.arange(200) == 7])
    counts = _counts(spark, matrix.astype(int).tolist())
    events = spark.createDataFrame([(f"E{i}",) for i in range(1, 13)], "event_id string")
    for limit in (0.3, 0.95):
        for chosen in (None, events):
            want = {(r.event_a, r.event_b): r.r for r in P.event_correlation(counts, chosen).collect() if r.r is not None and abs(r.r) > limit}
            found = {(r.event_a, r.event_b): r.r for r in P.strong_correlations(counts, limit, chosen).collect()}
            assert found == want and ("E7", "E8") in found and found["E7", "E8"] < -0.99


def test_wide_matrix_equals_the_pivot(spark, tmp_path):
    from logloom.sources.tables import export_cells_csv, export_matrix_csv

    rng = np.random.default_rng(4)
    counts = _counts(spark, rng.poisson(0.4, (60, 15)).tolist())
    for columns in ([f"E{i}" for i in range(1, 16)], ["E15", "E2", "E99"], ["E77"]):
        wide = C.with_total(C.occurrence_matrix(counts, columns))
        cells = C.cell_matrix(counts, columns)
        assert sorted((r.entity_id, *[r[c] for c in columns], r.total_events) for r in wide.collect()) == sorted(
            (r.entity_id, *r.cells, r.total_events) for r in cells.collect()
        )
    columns = [f"E{i}" for i in range(1, 16)]
    labels = spark.createDataFrame([("e1", 'odd, "quoted"'), ("e3", "Normal")], "entity_id string, label string")
    tables = (C.with_total(C.occurrence_matrix(counts, columns)), C.cell_matrix(counts, columns))
    for name, table, write in zip("ab", tables, (export_matrix_csv, lambda m, p: export_cells_csv(m, columns, p))):
        write(table.join(labels, "entity_id", "left"), str(tmp_path / name))
    read = [spark.read.csv(str(tmp_path / name), header=True, escape='"').collect() for name in "ab"]
    assert read[0][0].asDict().keys() == read[1][0].asDict().keys()
    assert sorted(map(str, read[0])) == sorted(map(str, read[1]))


def test_matrix_of_25000_events(spark, tmp_path):
    from logloom.sources.tables import export_cells_csv

    rows = [(f"e{i}", f"E{k}", i + 1) for i in range(5) for k in range(1 + i, 25001, 5)]
    counts = spark.createDataFrame(rows, "entity_id string, event_id string, n bigint")
    columns = [f"E{i}" for i in range(1, 25001)]
    export_cells_csv(C.cell_matrix(counts, columns), columns, str(tmp_path / "csv"))
    lines = [line for part in sorted((tmp_path / "csv").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines[0].split(",") == ["entity_id", *columns, "total_events"]
    found = {line.split(",")[0]: list(map(int, line.split(",")[1:])) for line in lines if not line.startswith("entity_id")}
    assert sorted(found) == ["e0", "e1", "e2", "e3", "e4"]
    for i in range(5):
        assert found[f"e{i}"] == [(i + 1) if k % 5 == i else 0 for k in range(25000)] + [(i + 1) * 5000]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantity_counts_aggregate_parts_before_steps(spark):
    from logloom.sources.samples import quantity_counts

    rows = [(1, 1.0), (1, 5.0), (2, 50.0), (2, None), (None, 3.0), (3, 0.0)]
    counts = quantity_counts(spark.createDataFrame(rows, "l_partkey int, l_quantity double"))
    # Read from the top: the steps are listed above the aggregate, so a part is one group and not twelve.
    plan = _plan(counts)
    assert plan.index("Generate") < plan.index("HashAggregate") and "Generate" not in plan[plan.index("HashAggregate") :]
    found = {(r.entity_id, r.event_id): r.n for r in counts.collect()}
    want = {("p1", "E1"): 2, ("p1", "E2"): 1, ("p1", "E3"): 1, (None, "E1"): 1, (None, "E2"): 1}
    assert found == want | {("p2", f"E{i}"): 1 for i in range(1, 12)}


def test_matrix_density_does_not_deal_counts_by_event(spark):
    counts = stage(spark.createDataFrame([("a", "E1", 2), ("b", "E1", 1), ("b", "E9", 1)], "entity_id string, event_id string, n bigint"), "test-counts")
    events = spark.createDataFrame([("E1",), ("E2",), ("E1",)], "event_id string")
    density = C.matrix_density(counts, events)
    assert "SortMergeJoin" not in _plan(density)
    assert tuple(density.first()) == (2, 2, 2, 50.0)
