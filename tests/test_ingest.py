from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from logloom import BLOCK_LOG
from logloom.plans import ingest as jobs
from logloom.sources import ledger
from logloom.sources.tables import export_matrix_csv, read_events, read_or_none

RECEIVE = "081109 203518 143 INFO dfs.Node: Receiving block blk_{i} src: /10.0.0.{i}:50010\n"
DELETE = "081109 203518 143 INFO dfs.Node: Deleting block blk_{i}\n"


def _log(folder, name, *parts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(p.format(i=i) for i, p in enumerate(parts)))


def _decisions(plan):
    return {r.source: r.decision for r in plan.collect()}


def _events(spark, out):
    return sorted((r.source, r.LineId, r.EventId, r.EventTemplate) for r in read_events(spark, out + "/events").collect())


def test_ingest_is_incremental(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _log(raw, "a.log", RECEIVE, RECEIVE, "\n", DELETE)
    first = jobs.ingest(spark, BLOCK_LOG, str(raw), out, ["a.log", "gone.log"])
    assert _decisions(first) == {"a.log": "parse", "gone.log": "missing"}
    once = _events(spark, out)
    assert [(r[1], r[2]) for r in once] == [(1, "E1"), (2, "E1"), (4, "E2")]
    columns = read_events(spark, out + "/events").columns
    assert columns == [*BLOCK_LOG.columns, "source"]

    # The same file again, and a new one with one new template.
    _log(raw, "b.log", DELETE, "completely other words here now\n")
    second = jobs.ingest(spark, BLOCK_LOG, str(raw), out)
    assert _decisions(second) == {"a.log": "skip", "b.log": "parse"}
    both = _events(spark, out)
    assert both[:3] == once
    assert [r[2] for r in both[3:]] == ["E2", "E3"]

    # Changed content replaces the rows of its source only, with the known ids.
    _log(raw, "a.log", DELETE)
    third = jobs.ingest(spark, BLOCK_LOG, str(raw), out)
    assert _decisions(third) == {"a.log": "reparse", "b.log": "skip"}
    assert [(r[0], r[2]) for r in _events(spark, out)] == [("a.log", "E2"), ("b.log", "E2"), ("b.log", "E3")]
    totals = {r.EventId: r.Occurrences for r in jobs.templates(spark, out).collect()}
    assert totals == {"E1": 0, "E2": 2, "E3": 1}
    known = {r.source: (r.num_lines, r.num_templates) for r in ledger.latest(ledger.read_ledger(spark, out + "/ledger")).collect()}
    assert known == {"a.log": (1, 1), "b.log": (2, 2)}


def test_archive_and_clear(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _log(raw, "a.log", RECEIVE)
    jobs.ingest(spark, BLOCK_LOG, str(raw), out, ["a.log"], archive=str(tmp_path / "done"))
    assert not (raw / "a.log").exists()
    assert [p.name.split("_")[0] for p in (tmp_path / "done").iterdir() if p.suffix != ".crc"] == ["a.log"]
    again = jobs.ingest(spark, BLOCK_LOG, str(raw), out, ["a.log"])
    assert _decisions(again) == {"a.log": "archived"}
    ledger.clear(spark, out + "/ledger", "a.log")
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out, ["a.log"])) == {"a.log": "missing"}


def test_ledger_edges(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).isEmpty()
    (tmp_path / "ledger").mkdir()
    (tmp_path / "ledger" / "part-0.parquet").write_bytes(b"not a table")
    assert ledger.read_ledger(spark, path).isEmpty()
    rows = spark.createDataFrame([("a", "1", 3, 1), ("b", "2", 4, 2)], "source string, fingerprint string, num_lines int, num_templates int")
    ledger.record(rows, path)
    assert ledger.latest(ledger.read_ledger(spark, path)).count() == 2
    ledger.clear(spark, path)
    assert ledger.latest(ledger.read_ledger(spark, path)).isEmpty()
    ledger.record(rows.filter("source = 'a'"), path)
    assert [r.source for r in ledger.latest(ledger.read_ledger(spark, path)).collect()] == ["a"]


def test_damaged_ledger_forgets_what_it_lost(spark, tmp_path):
    path = str(tmp_path / "ledger")
    schema = "source string, fingerprint string, num_lines int, num_templates int"
    for name in "abc":
        ledger.record(spark.createDataFrame([(name, "1", 3, 1)], schema), path)
    before = set((tmp_path / "ledger").glob("part-*.parquet"))
    ledger.record(spark.createDataFrame([("a", "2", 5, 1)], schema), path)
    ledger.clear(spark, path, "c")
    assert {r.source: r.fingerprint for r in ledger.latest(ledger.read_ledger(spark, path)).collect()} == {"a": "2", "b": "1"}
    # The newest row of a and the one that clears c are damaged: older rows of both must not come back.
    for part in set((tmp_path / "ledger").glob("part-*.parquet")) - before:
        part.write_bytes(b"PAR1 damaged")
    assert {(r.source, r.cleared) for r in ledger.lost_rows(spark, path).collect()} == {("a", False), ("c", True)}
    assert [r.source for r in ledger.latest(ledger.read_ledger(spark, path)).collect()] == ["b"]
    ledger.record(spark.createDataFrame([("a", "2", 5, 1)], schema), path)
    assert {r.source: r.fingerprint for r in ledger.latest(ledger.read_ledger(spark, path)).collect()} == {"a": "2", "b": "1"}
    # All files gone: nothing is known, and every row is named.
    for part in (tmp_path / "ledger").glob("part-*.parquet"):
        part.unlink()
    assert ledger.latest(ledger.read_ledger(spark, path)).isEmpty()
    assert ledger.lost_rows(spark, path).select("source").distinct().count() == 3


def test_unchanged_files_are_not_read(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _log(raw, "a.log", RECEIVE, DELETE)
    _log(raw, "b.log", DELETE)
    for name in ("a.log", "b.log"):
        os.utime(raw / name, (1_700_000_000, 1_700_000_000))
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a.log": "parse", "b.log": "parse"}
    once = _events(spark, out)
    read = []

    class Watched(jobs.TextSource):
        def __init__(self, spark, root, pattern="*", sources=None):
            read.append(sources)
            super().__init__(spark, root, pattern, sources)

    monkeypatch.setattr(jobs, "TextSource", Watched)
    # Nothing changed: no text is scanned at all.
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a.log": "skip", "b.log": "skip"}
    assert read == [] and _events(spark, out) == once
    # Same content under a new time: read once, known by the new time from then on.
    os.utime(raw / "b.log", (1_700_000_100, 1_700_000_100))
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a.log": "skip", "b.log": "skip"}
    assert read == [["b.log"]]
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a.log": "skip", "b.log": "skip"}
    assert read == [["b.log"]] and _events(spark, out) == once
    # A file that changed just now has no trusted time, whatever its length.
    (raw / "b.log").write_text((raw / "b.log").read_text().replace("Deleting", "Removing"))
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a.log": "skip", "b.log": "reparse"}
    assert [r[3] for r in _events(spark, out) if r[0] == "b.log"] == ["Removing block <BLOCK>"]


def test_blanked_file_loses_its_events(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _log(raw, "a b%.log", RECEIVE)
    _log(raw, "b.log", DELETE)
    jobs.ingest(spark, BLOCK_LOG, str(raw), out)
    (raw / "a b%.log").write_text("\n \n")
    plan = jobs.ingest(spark, BLOCK_LOG, str(raw), out)
    assert _decisions(plan) == {"a b%.log": "reparse", "b.log": "skip"}
    assert [r[0] for r in _events(spark, out)] == ["b.log"]
    assert _decisions(jobs.ingest(spark, BLOCK_LOG, str(raw), out)) == {"a b%.log": "skip", "b.log": "skip"}


def test_json_ledger(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text('{"X.log": {"file_hash": "ab", "last_parsed": "2024-03-05T06:07:08.900000", "num_lines": 7, "num_templates": 2}}')
    (row,) = ledger.latest(ledger.read_json_ledger(spark, str(path))).collect()
    assert (row.source, row.fingerprint, row.num_lines, row.num_templates) == ("X.log", "ab", 7, 2)


def test_missing_table_and_csv_export(spark, tmp_path):
    assert read_or_none(spark, str(tmp_path / "none")) is None
    matrix = spark.createDataFrame([("b", 1), ("a", 0)], "entity_id string, E1 bigint")
    export_matrix_csv(matrix, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, schema="entity_id string, E1 bigint")
    assert sorted(tuple(r) for r in back.collect()) == [("a", 0), ("b", 1)]


def test_plan_covers_all_cases(spark):
    names = ["new", "same", "changed", "archived", "missing"]
    wanted = spark.createDataFrame([(n,) for n in names], "source string")
    present = spark.createDataFrame([("new", "1"), ("same", "1"), ("changed", "2")], "source string, fingerprint string")
    known = spark.createDataFrame(
        [("same", "1", 5, 1), ("changed", "1", 5, 1), ("archived", "9", 5, 1)],
        "source string, fingerprint string, num_lines int, num_templates int",
    )
    plan = _decisions(ledger.plan_ingest(wanted, present, known))
    assert plan == {"new": "parse", "same": "skip", "changed": "reparse", "archived": "archived", "missing": "missing"}


@pytest.mark.parametrize("seen, listed, label", [
    ([1, 3], True, "Anomaly"), ([2, 3], False, "Normal"), ([3], False, "Anomaly"), ([1], False, "Normal"), ([3, 1], False, "Normal"),
])
def test_label_precedence(spark, seen, listed, label):
    from logloom.operators.labels import label_by_precedence

    rows = [("x", s, "Anomaly" if s == 3 else "Normal") for s in seen] + [(None, 1, "Normal")]
    tagged = spark.createDataFrame(rows, "InstanceId string, source_order int, source_label string")
    ids = spark.createDataFrame([("x",)] if listed else [("y",)], "entity_id string")
    assert [tuple(r) for r in label_by_precedence(tagged, "InstanceId", ids).collect()] == [("x", label)]


def test_join_without_labels_and_class_check(spark):
    from logloom.operators import labels as L

    matrix = spark.createDataFrame([("a", 1), ("b", 2)], "entity_id string, E1 bigint")
    assert L.join_labels(matrix, None) is matrix
    labelled = L.join_labels(matrix, spark.createDataFrame([("a", "Anomaly")], "entity_id string, label string"))
    target = L.binary_target(labelled, "Anomaly")
    assert {r.entity_id: r.target for r in target.collect()} == {"a": 1, "b": 0}
    assert L.binary_target(labelled, "Anomaly", drop_unlabelled=True).count() == 1
    L.require_both_classes(target)
    with pytest.raises(ValueError, match="both classes"):
        L.require_both_classes(L.binary_target(labelled, "Fail"))
    assert L.anomaly_instances(spark).filter(F.length("entity_id") == 36).count() == 4
