from __future__ import annotations

from logloom import BLOCK_LOG
from logloom.operators.parse import parse_lines
from logloom.plans import ingest as jobs
from logloom.plans.queries import QUERIES
from logloom.sources.lines import clean_lines, read_lines
from logloom.sources.tables import read_events
from logloom.streaming import ingest as S

LINE = "081109 203518 143 INFO dfs.Node: Receiving block blk_{} src: /10.0.0.1:50010\n"


def _write(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(LINE.format(i) for i in ids) + "\ngarbage\n")


def _ingest(spark, raw, out, state, **options):
    events = S.parse_stream(S.stream_lines(spark, str(raw), **options), BLOCK_LOG)
    S.ingest_stream(events, out, state).awaitTermination()


def test_each_file_is_read_once_and_equals_batch(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    _write(raw, "a.log", range(5))
    _ingest(spark, raw, out, state)
    _ingest(spark, raw, out, state)
    assert spark.read.parquet(out).count() == 6
    _write(raw, "b.log", range(3))
    _ingest(spark, raw, out, state)
    streamed = spark.read.parquet(out)
    batch = parse_lines(clean_lines(read_lines(spark, str(raw))), BLOCK_LOG)
    columns = ["source", "is_parsed", *BLOCK_LOG.fields, "BlockId"]
    assert sorted(map(tuple, streamed.select(*columns).collect()), key=str) == sorted(
        map(tuple, batch.select(*columns).collect()), key=str
    )


def test_read_files_are_archived_by_a_later_batch(spark, tmp_path):
    raw, out, state, done = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state"), tmp_path / "done"
    for name in "abc":
        _write(raw, f"{name}.log", [1])
        _ingest(spark, raw, out, state, archive=str(done))
    archived = {p.name for p in done.rglob("*.log")}
    assert archived and archived < {"a.log", "b.log", "c.log"}
    assert spark.read.parquet(out).count() == 6


def _log_stream(spark, raw, out, state, **options):
    S.ingest_log_stream(spark, BLOCK_LOG, str(raw), out, state, pattern="*.log", **options).awaitTermination()


def _rows(spark, out):
    rows = read_events(spark, f"{out}/events").collect()
    return sorted((r.source, r.LineId, r.Content, r.BlockId or "", r.EventId, r.EventTemplate) for r in rows)


def test_streamed_events_equal_an_ingest(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    for name in "ab":
        _write(raw, f"{name}.log", range(3))
    _log_stream(spark, raw, out, state)
    # Two more batches: known templates keep their ids, new ones follow.
    (raw / "c.log").write_text("081109 203518 143 INFO dfs.Node: wholly other words come here blk_9\n\n" + LINE.format(4))
    _log_stream(spark, raw, out, state)
    _log_stream(spark, raw, out, state)
    batch = str(tmp_path / "batch")
    jobs.ingest(spark, BLOCK_LOG, str(raw), batch)
    assert _rows(spark, out) == _rows(spark, batch) and len(_rows(spark, out)) == 10
    assert read_events(spark, f"{out}/events").columns == read_events(spark, f"{batch}/events").columns
    found, want = (sorted(map(tuple, jobs.templates(spark, x).select("EventId", "EventTemplate", "Occurrences").collect())) for x in (out, batch))
    assert found == want


def test_a_batch_that_runs_again_replaces_its_part(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), tmp_path / "state"
    _write(raw, "a.log", range(3))
    _log_stream(spark, raw, out, str(state))
    (raw / "b.log").write_text("081109 203518 143 INFO dfs.Node: something else was said\n")
    _log_stream(spark, raw, out, str(state))
    once = _rows(spark, out)
    # The last batch did its work, but its end was not noted.
    for mark in (state / "commits").glob("*1*"):
        mark.unlink()
    _log_stream(spark, raw, out, str(state))
    assert _rows(spark, out) == once
    texts = [r.EventTemplate for r in jobs.templates(spark, out).collect()]
    assert len(texts) == len(set(texts)) == 3


def test_vectorize_reads_the_table_of_the_stream(spark, tmp_path):
    from logloom.__main__ import main

    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _write(raw, "a.log", [1, 1, 2])
    _log_stream(spark, raw, out, str(tmp_path / "state"))
    jobs.templates(spark, out).write.parquet(f"{out}/templates")
    main(["vectorize", "--format", "block", "--out", out])
    assert sorted((r.entity_id, r.total_events) for r in spark.read.parquet(f"{out}/matrix").collect()) == [("blk_1", 2), ("blk_2", 1)]


def test_runs_are_merged_by_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "FANOUT", 2)
    out = str(tmp_path / "out")
    write = S._batch_writer("entity", "event", out)
    schema = "entity string, event string"

    def counts():
        return {(r.entity_id, r.event): r.n for r in S.running_counts(spark, out).collect()}

    assert counts() == {}
    want = {}
    for batch_id in range(13):
        rows = [("x", "a"), (f"y{batch_id % 3}", "b"), (None, "c")]
        write(spark.createDataFrame(rows, schema), batch_id)
        for entity, event in rows[:2]:
            want[entity, event] = want.get((entity, event), 0) + 1
        assert counts() == want
        live = S._live(S._runs(spark, out))
        assert len(live) == (batch_id + 1).bit_count()
    # 13 batches are runs of 8, 4 and 1; what they replaced is gone but for the last merge.
    assert sorted(live) == [(0, 7), (8, 11), (12, 12)] and len(S._runs(spark, out)) <= 8
    # A merge that was killed has left files without its mark, and a batch in a merged run comes again.
    killed = tmp_path / "out" / "batch_id=12-13"
    killed.mkdir()
    (killed / "part-0.parquet").write_bytes(b"half")
    write(spark.createDataFrame([("x", "a")], schema), 3)
    assert counts() == want
    write(spark.createDataFrame([("x", "a")], schema), 13)
    want["x", "a"] += 1
    assert counts() == want and sorted(S._live(S._runs(spark, out))) == [(0, 7), (8, 11), (12, 13)]


def test_counts_over_batches_survive_a_rerun(spark, tmp_path):
    raw, out, state = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "state")
    for n, name in enumerate("abcd"):
        _write(raw, f"{name}.log", [1] * n + [2])

    def run():
        events = S.parse_stream(S.stream_lines(spark, str(raw), files_per_batch=1), BLOCK_LOG)
        S.count_stream(events, "BlockId", "signature", out, state).awaitTermination()
        return {r.entity_id: r.n for r in S.running_counts(spark, out).collect()}

    assert run() == {"blk_1": 6, "blk_2": 4}
    # A batch that runs again replaces its own part.
    batch = spark.read.parquet(f"{out}/batch_id=1")
    again = spark.createDataFrame(batch.collect(), batch.schema)
    events = again.selectExpr("entity_id as BlockId", "event as signature", "explode(sequence(1, n)) as i")
    S._batch_writer("BlockId", "signature", out)(events, 1)
    assert run() == {"blk_1": 6, "blk_2": 4}


def test_streamed_counts_equal_batch_counts(spark, sf_dir):
    streamed = QUERIES["stream_counts"](spark, sf_dir)
    batch = QUERIES["entity_event_counts"](spark, sf_dir)
    assert sorted((r.entity_id, r.n) for r in streamed.collect()) == sorted((r.entity_id, r.n) for r in batch.collect())
