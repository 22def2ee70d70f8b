from __future__ import annotations

import random

from logloom.sources.labels import read_label_csv, read_label_ids
from logloom.sources.lines import TextSource, clean_lines, fingerprints, read_lines


def _write(folder, name, data: bytes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)


def test_numbers_bytes_and_line_ends(spark, tmp_path):
    raw = tmp_path / "raw"
    _write(raw, "b.log", b"one\r\n\r\n  two \xff\xfe \n\xff\nthree")
    _write(raw, "a.log", b"x\n\ny\n")
    lines = clean_lines(read_lines(spark, str(raw)))
    got = sorted((r.source, r.source_order, r.LineId, r.value) for r in lines.collect())
    assert got == [("a.log", 1, 1, "x"), ("a.log", 1, 3, "y"), ("b.log", 2, 1, "one"), ("b.log", 2, 3, "two"), ("b.log", 2, 5, "three")]


def test_numbers_over_many_splits(spark, tmp_path):
    rng = random.Random(7)
    raw = tmp_path / "raw"
    expected = {}
    for name in ("p.log", "q.log", "sub"):
        texts = ["w" * rng.randint(0, 60) for _ in range(400)]
        folder = raw
        if name == "sub":
            raw.joinpath("deep").mkdir()
            folder, name = raw / "deep", "r.log"
        _write(folder, name, ("\n".join(texts) + "\n").encode())
        source = name if folder == raw else f"deep/{name}"
        expected.update({(source, i): t for i, t in enumerate(texts, 1)})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = read_lines(spark, str(raw))
        assert lines.rdd.getNumPartitions() > 10
        got = {(r.source, r.LineId): r.value for r in lines.collect()}
        marks = sorted(map(tuple, TextSource(spark, str(raw)).fingerprints().collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == expected
    # One pass over splits gives the marks of the numbered lines, however the file was split.
    assert marks == sorted(map(tuple, fingerprints(read_lines(spark, str(raw))).collect()))


def test_text_is_not_shuffled_whatever_the_number_of_splits(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    for name in ("a.log", "b.log", "c.log"):
        _write(raw, name, b"".join(b"%s line %d\n" % (name.encode(), i) for i in range(300)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    whole = sorted(map(tuple, read_lines(spark, str(raw)).collect()))
    # A page bound far below the number of splits: more pages, still no shuffle of lines.
    monkeypatch.setattr("logloom.sources.lines.PAGE_SPLITS", 3)
    monkeypatch.setattr("logloom.session.BROADCAST_ROWS", 1)
    try:
        source = TextSource(spark, str(raw))
        lines = source.lines()
        plan = lines._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, lines.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert source._pages > 3 and "BroadcastHashJoin" in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "SortMergeJoin" not in plan
    assert got == whole
    # The number over all sources follows their order.
    assert sorted(r[4] for r in got) == list(range(1, 901))
    assert [r[1:4] for r in sorted(got, key=lambda r: r[4])] == sorted(r[1:4] for r in got)


def test_listed_sources_keep_their_order_and_absent_ones_are_skipped(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("a.log", "b.log", "c.log"):
        _write(raw, name, name.encode())
    lines = read_lines(spark, str(raw), sources=["c.log", "gone.log", "a.log"])
    assert sorted((r.source_order, r.source) for r in lines.collect()) == [(1, "c.log"), (3, "a.log")]
    # Each of these small files is a task of its own, and the unlisted one is not read.
    assert read_lines(spark, str(raw)).rdd.getNumPartitions() == 3
    assert lines.rdd.getNumPartitions() == 2


def test_fingerprint_sees_content_and_order(spark, tmp_path):
    raw = tmp_path / "raw"
    _write(raw, "a.log", b"x\ny\n")
    _write(raw, "b.log", b"y\nx\n")
    _write(raw, "c.log", b"x\ny\n")
    marks = {r.source: (r.num_lines, r.fingerprint) for r in fingerprints(read_lines(spark, str(raw))).collect()}
    assert marks["a.log"] == marks["c.log"] != marks["b.log"]


def test_label_sources(spark, tmp_path):
    ids = tmp_path / "ids.txt"
    ids.write_text("These are anomalous.\n\n544fd51c-4edc-4780-baae-ba1d80a0acfc\n ae651dff-c7ad-43d6-ac96-bbcd820ccca8 \nblk_1\n")
    got = sorted(r[0] for r in read_label_ids(spark, str(ids)).collect())
    assert got == ["544fd51c-4edc-4780-baae-ba1d80a0acfc", "ae651dff-c7ad-43d6-ac96-bbcd820ccca8"]
    assert read_label_csv(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "l.csv").write_text("BlockId,Label\nblk_-1,Normal\nblk_2,Anomaly\n")
    got = sorted(tuple(r) for r in read_label_csv(spark, str(tmp_path / "l.csv")).collect())
    assert got == [("blk_-1", "Normal"), ("blk_2", "Anomaly")]
