"""Near duplicates: Jaccard groups, embedding links and connected components."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from logloom.llm import jaccard, memory
from logloom.llm.components import connected_components
from logloom.llm.embeddings import embedding_duplicates, representatives, unit_rows
from logloom.llm.jaccard import Shingler, bitmap, bits_for, fold, jaccard_components, keep_one_per_group, overlap


class Groups:
    def __init__(self, size):
        self.up = list(range(size))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def _jaccard(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    groups = Groups(len(rows))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(groups.find(i), []).append(doc_id)
    return sorted((rows[i][0], len(sets[i]), min(least[groups.find(i)])) for i in range(len(rows)))


def _documents():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(40):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        if i % 3 == 0:
            body[len(body) // 2 : len(body) // 2] = passage
        for j in range(rng.choice([1, 1, 2, 25])):
            copy = list(body)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy).upper() if j % 5 == 4 else "\n".join(copy)))
    extra = [None, "", " \t", "a b", "A  b", "é x", rows[3][1]]
    return rows + [(5000 + i, x) for i, x in enumerate(extra)] + [rows[3]]


def test_jaccard_groups_equal_brute_force(spark):
    rows = _documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = _jaccard(rows)
    for options in ({}, {"tile_rows": 4, "common_most": 30}):
        found = jaccard_components(df, **options).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_a_passage_spread_over_tasks_makes_no_pairs(spark, monkeypatch):
    # Two or three holders a task, so no task sees that the passage is common; seven in ten words of a document are the passage's.
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"{passage} " + " ".join(f"d{i}w{j}" for j in range(30))) for i in range(60)]
    rows += [(100 + i, f"{text} end") for i, text in rows[:5]]
    paired = []

    def stage(df, label):
        staged = whole(df, label)
        paired.extend(staged.collect() if label == "pairs" else [])
        return staged

    whole = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", stage)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartitionByRange(32, "doc_id")
    found = jaccard_components(df).collect()
    assert paired == []
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted((i, i - 100 if i >= 100 else i) for i, _ in rows)


def test_sets_are_shuffled_once_on_their_way_to_tiles(spark, monkeypatch):
    plans = []

    def stage(df, label):
        if label == "tile-links":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            raise InterruptedError
        return whole(df, label)

    whole = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", stage)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id bigint, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jaccard_components(df)
    except InterruptedError:
        pass
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0]


class Sent:
    def __init__(self, value):
        self.value = value


def test_only_sets_of_groups_are_shuffled_to_meet_them(spark):
    rng = random.Random(8)
    sets = {node: np.unique([rng.randrange(1 << 62) for _ in range(rng.randint(1, 30))]) for node in range(40)}
    rows = [(node, len(x), x.tobytes()) for node, x in sets.items()]
    df = spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in rows], "node bigint, n bigint, hashes binary")
    groups = spark.createDataFrame([(3, 3), (9, 3), (17, 11)], "node bigint, component bigint")
    levels = np.array([2, 0, 1], np.uint16)
    component = {3: 3, 9: 3, 17: 11}
    want = set()
    for node, x in sets.items():
        first = sorted(x.tolist(), key=lambda h: (levels[h % 3], h))[: jaccard.prefix_size(len(x))]
        want |= {(h, node, node - component.get(node, node), (len(x) << 32) + i) for i, h in enumerate(first)}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tokens = jaccard.prefix_tokens(df, groups, levels)
        found = [tuple(r) for r in tokens.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(found) == sorted(want)
    # Of 40 sets the join gets three.
    bits = dict(df.select("node", jaccard._bit(jaccard.F.col("node"))).collect())
    filled = jaccard._filter_of(groups.select("node"))
    batch = pa.RecordBatch.from_pydict({"node": list(sets), "n": [x[1] for x in rows], "hashes": [x[2] for x in rows], "bit": [bits[x] for x in sets]})
    sides = [[x for b in jaccard._prefix([batch], Sent(levels), Sent(filled), hit) for x in b.column("node").to_pylist()] for hit in (True, False)]
    assert sides[0] == [3, 9, 17] and sorted(sides[0] + sides[1]) == list(range(40))


def test_workers_get_small_batches_and_keep_no_tool(spark, monkeypatch):
    bounds = []

    def stage(df, label):
        bounds.append(int(spark.conf.get(memory.BATCH_BYTES, "0")))
        return whole(df, label)

    whole = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", stage)
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id bigint, text string")
    jaccard_components(df)
    assert len(bounds) > 3 and all(0 < x <= memory.SLICE_BYTES for x in bounds)
    assert spark.conf.get(memory.BATCH_BYTES, None) is None
    monkeypatch.setitem(memory._HELD, ("earlier",), "tool")
    assert list(memory.lean(iter)([1, 2])) == [1, 2] and not memory._HELD


def test_one_document_of_a_group_stays(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(3, words, "a"), (1, words + " end", "b"), (2, "other text", "c"), (None, words, "d"), (4, None, "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.component_id for r in kept.collect()) == ["b", "c", "d", "e"]


def test_empty_tables(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert embedding_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 2**62, rng.integers(1, 300))) for _ in range(2))
        b = np.unique(np.concatenate([b, rng.choice(a, len(a) // 2)]))
        bits = bits_for(max(len(a), len(b)))
        differ = int(np.bitwise_count(bitmap(a, bits) ^ bitmap(b, bits)).sum())
        assert overlap(a, b) == len(set(a) & set(b)) <= (len(a) + len(b) - differ) // 2
    assert fold(bitmap(a, 1024)[None, :], 128).shape == (1, 2)
    assert (fold(bitmap(a, 1024)[None, :], 128).view(np.uint8).sum() > 0) or not len(a)


def test_shingles_ignore_case_and_white_space():
    shingler = Shingler()
    assert (shingler.shingles("A b\tc D e f") == shingler.shingles(" a\nB C d E  F ")).all()
    assert len(shingler.shingles("a b c d e f")) == 2
    assert len(shingler.shingles("x")) == 1 and len(shingler.shingles(None)) == 0


def _links(rows, cosine=0.95):
    fine = [i for i, (_, e) in enumerate(rows) if e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    near = unit_rows(np.array([rows[i][1] for i in fine], float))
    hits = near @ near.T >= cosine
    groups = Groups(len(rows))
    for a, b in zip(*np.nonzero(hits)):
        groups.join(fine[a], fine[b])
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        least.setdefault(groups.find(i), []).append(vec_id)
    links = {i: int(n) - 1 for i, n in zip(fine, hits.sum(1))}
    return sorted((v, links.get(i, 0), min(least[groups.find(i)])) for i, (v, _) in enumerate(rows))


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(20, 8))
    rows = []
    for i in range(300):
        noise = rng.normal(size=8) * rng.choice([0.05, 0.2, 0.4])
        rows.append((i, [float(np.float32(x)) for x in base[rng.integers(20)] + noise]))
    rows += [(2000 + i, rows[7][1]) for i in range(20)]
    odd = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [], [float("inf")] + [1.0] * 7]
    rows += [(3000 + i, x) for i, x in enumerate(odd)] + [rows[3]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = embedding_duplicates(df, sample_rows=100, max_cells=6, block_rows=30, cell_rows=50).collect()
    want = _links(rows)
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert sorted(r.vec_id for r in representatives(df).collect()) == sorted({c for _, _, c in want})


def test_chains_inside_a_large_block_stay_whole(spark):
    # One cell of one block, compared in three steps; few neighbours each, so groups are chains and no cliques.
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(1500), rng.normal(size=(1500, 3)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    found = embedding_duplicates(df, cosine=0.998).collect()
    want = _links(rows, 0.998)
    assert 100 < len({c for _, _, c in want}) < 1200
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(want)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, None)]
    found = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.node: r.component for r in found} == {**{i: 0 for i in range(31)}, **{x: 100 for x in range(100, 140)}}
    assert len(found) == 71


def test_kept_rows_of_repeated_and_missing_ids(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, words, "a", 1, "k"), (2, words + " tail", "b", 2, "k"), (3, "other words stand here alone now", "c", 3, "k"), (3, "short", "d", 4, "k"),
        (3, "other words stand here alone now", "e", 5, "k"), (None, words, "f", 6, "k"), (7, None, "g", 7, "k"), (8, "", "h", 8, "k"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string, row int, id string")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.row) for r in kept.collect())[1:] in ([(1, 1), (3, 3), (7, 7), (8, 8)], [(1, 1), (3, 5), (7, 7), (8, 8)])
    assert keep_one_per_group(df.limit(0)).count() == 0
