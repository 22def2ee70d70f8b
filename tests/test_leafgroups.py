from __future__ import annotations

import random

import numpy as np
import pytest
from test_templates import CONFIGS, _free_text, _mined, _random_signatures, model

from logloom.functions.formats import MiningConfig
from logloom.operators import leafgroups
from logloom.operators import templates as T


@pytest.fixture
def in_tasks(monkeypatch):
    """Leaves go to tasks however few signatures there are, several buckets of them."""
    monkeypatch.setattr(T, "FEW", 0)
    monkeypatch.setattr(T, "BUCKET_CELLS", 300)
    monkeypatch.setattr(T, "LARGE", 10)


def _plain(ids, need):
    def equal(a, b):
        return int(((ids[a] == ids[b]) & (ids[a] >= 0)).sum())

    leaders = []
    for i in range(len(ids)):
        if not any(equal(i, j) >= need for j in leaders):
            leaders.append(i)
    return [i if i in leaders else min(leaders, key=lambda j: (-equal(i, j), j)) for i in range(len(ids))]


def test_groups_of_a_leaf_equal_the_plain_loop(monkeypatch):
    rng = np.random.default_rng(0)
    for case in range(150):
        rows, width, words = (int(rng.integers(1, most)) for most in (120, 12, 25))
        ids = rng.integers(-1, words, (rows, width)).astype(np.int32)
        if case % 3 == 0:
            ids[:, 0] = 3
        monkeypatch.setattr(leafgroups, "FRONT", (2, 64, 10)[case % 3])
        monkeypatch.setattr(leafgroups, "CHUNK_CELLS", (50, 4_000_000)[case % 2])
        need = int(rng.integers(0, width + 2))
        assert leafgroups.leader_of(ids, need).tolist() == _plain(ids, need)


def test_needed_tokens():
    assert [leafgroups.needed(n, 0.4) for n in (0, 1, 5, 6, 10)] == [1, 1, 2, 3, 4]
    assert leafgroups.needed(4, 0.0) == 0 and leafgroups.needed(4, 1.5) == 5


@pytest.mark.parametrize("config", CONFIGS, ids=str)
def test_mining_in_tasks_equals_the_line_by_line_model(spark, config, in_tasks):
    for seed in (1, 2):
        signatures = _random_signatures(seed)
        assert _mined(spark, signatures, config) == model(signatures, config)


def test_leaves_beyond_a_task_take_the_joins(spark, in_tasks, monkeypatch):
    signatures = _random_signatures(5)
    monkeypatch.setattr(T, "LEAF_CELLS", 100)
    config = MiningConfig(batch=3)
    assert _mined(spark, signatures, config) == model(signatures, config)


def test_mining_keeps_no_second_copy_of_tokens(spark, in_tasks):
    """What mining leaves in the shared folder is a small multiple of its input, with groups of one as with large ones."""
    from pathlib import Path

    from logloom.session import new_dir, stage

    folder = Path(new_dir(spark, "x")).parent

    def kept() -> set:
        return set(folder.glob("*"))

    rows = [(text, 1, i + 1) for i, text in enumerate(_free_text(4000))]
    random.Random(1).shuffle(rows)
    signatures = stage(spark.createDataFrame(rows, "signature string, lines bigint, seen_at bigint"), "signatures")
    before = kept()
    dictionary, assignment = T.mine(signatures, MiningConfig())
    size = {path.name.split("-")[0]: sum(f.stat().st_size for f in path.rglob("*.parquet")) for path in kept() - before}
    text = sum(len(row[0]) for row in rows)
    assert assignment.count() == len(rows) and dictionary.count() == assignment.select("event_no").distinct().count()
    assert "leaves" not in size and "grouped" not in size and sum(size.values()) < text
