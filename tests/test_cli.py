"""The four steps end to end on both log families."""

from __future__ import annotations

import pytest

from logloom import __main__ as cli
from logloom import session

UUIDS = [f"{i:08d}-aaaa-bbbb-cccc-{i:012d}" for i in range(40)]


@pytest.fixture(autouse=True)
def keep_staged(monkeypatch):
    monkeypatch.setattr(cli, "drop_staged", lambda spark: None)


def _block_log(path):
    lines, labels = [], ["BlockId,Label"]
    for i in range(60):
        bad = i % 5 == 0
        head = "081109 203518 143 INFO dfs.Node: "
        lines += [f"{head}Receiving block blk_{i} src: /10.0.0.{i}:50010"] * (1 + i % 3)
        lines += [f"{head}Exception writing blk_{i} to mirror"] * (i % 2 + (4 if bad else 0))
        if i % 9:
            labels.append(f"blk_{i},{'Anomaly' if bad else 'Normal'}")
    path.mkdir()
    (path / "block.log").write_text("\n".join(lines) + "\n")
    (path.parent / "labels.csv").write_text("\n".join(labels) + "\n")


def test_block_family(spark, tmp_path, capsys):
    _block_log(tmp_path / "raw")
    base = ["--format", "block", "--out", str(tmp_path / "out")]
    cli.main(["ingest", *base, "--raw", str(tmp_path / "raw"), "--archive", str(tmp_path / "done")])
    cli.main(["vectorize", *base, "--labels", str(tmp_path / "labels.csv"), "--csv"])
    cli.main(["profile", *base])
    cli.main(["train", *base, "--folds", "3", "--trees", "5"])
    out = tmp_path / "out"
    matrix = spark.read.parquet(str(out / "matrix"))
    assert matrix.columns == ["entity_id", "E1", "E2", "total_events", "label"]
    assert matrix.count() == 60 and matrix.filter("label is null").count() == 7
    assert spark.read.csv(str(out / "matrix_csv"), header=True).count() == 60
    rate = spark.read.parquet(str(out / "profile" / "anomaly_rate")).first()
    assert rate.entities == 60 and 0 < rate.anomalies < 12
    summary = spark.read.parquet(str(out / "model" / "summary"))
    assert {r.model for r in summary.collect()} == {"Logistic Regression", "Random Forest"}
    assert "Exception writing <BLOCK> to mirror" in capsys.readouterr().out


def test_vm_family(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def text(name, ids):
        head = f"{name} 2017-05-16 00:00:04.500 2931 INFO nova.manager [req-1 - -] "
        return "".join(f"{head}[instance: {UUIDS[i]}] VM Started\n{head}[instance: {UUIDS[i]}] Took {i}.5 seconds\n" for i in ids)

    (raw / "n1.log").write_text(text("n1.log", range(0, 20)))
    (raw / "ab.log").write_text(text("ab.log", range(15, 30)))
    (tmp_path / "ids.txt").write_text(f"Anomalies.\n\n{UUIDS[2]}\n")
    base = ["--format", "vm", "--out", str(tmp_path / "out")]
    cli.main(["ingest", *base, "--raw", str(raw), "--sources", "n1.log", "n2.log", "ab.log"])
    labels = ["--source-label", "n1.log=Normal", "n2.log=Normal", "ab.log=Anomaly"]
    cli.main(["vectorize", *base, *labels, "--label-ids", str(tmp_path / "ids.txt")])
    rows = {r.entity_id: r for r in spark.read.parquet(str(tmp_path / "out" / "matrix")).collect()}
    assert len(rows) == 30
    assert {UUIDS.index(k) for k, r in rows.items() if r.label == "Anomaly"} == {2, *range(20, 30)}
    assert (rows[UUIDS[16]].E1, rows[UUIDS[16]].E2, rows[UUIDS[16]].total_events) == (2, 2, 4)


def test_staging(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    assert session.stage(spark.range(3), "t").count() == 3
    session.drop_staged(spark)
    assert not list((tmp_path / "shared" / "logloom").iterdir())


def test_broadcast_is_checked(spark):
    df = spark.createDataFrame([(i, "x" * 100, ["y"]) for i in range(50)], "i int, s string, a array<string>")

    def hinted(other):
        return "hint" in other._jdf.queryExecution().logical().toString().lower()

    assert hinted(session.broadcast_if_small(df))
    assert not hinted(session.broadcast_if_small(df, rows=49))
    assert not hinted(session.broadcast_if_small(df, size=5000))
