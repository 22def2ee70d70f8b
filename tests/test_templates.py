"""Mining against a line-by-line model of the same rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from logloom import BLOCK_LOG, MiningConfig
from logloom.operators import templates as T
from logloom.operators.templates import current_dictionary, mine
from logloom.plans.structure import structure
from logloom.session import stage

WILD = "<*>"


def _similarity(a, b):
    return sum(x == y != WILD for x, y in zip(a, b)) / max(len(a), 1)


def _leaf_keys(rows, config):
    keep, nodes, heads = config.max_children - 1, {}, {}
    for sig in rows:
        words, path = sig.split(" ") if sig else [], ()
        for level in range(min(config.head_tokens, len(words))):
            head = WILD if re.search(r"\d", words[level]) else words[level]
            known = nodes.setdefault((len(words), path), [])
            if head != WILD and head not in known and len(known) < keep:
                known.append(head)
            path += (head if head in known else WILD,)
        heads[sig] = (len(words), path)
    return heads


def model(signatures: list[str], config: MiningConfig):
    """Signatures in order of appearance to ``{signature: (number, template)}``."""
    keys = _leaf_keys(signatures, config)
    leaders = {}
    for sig in signatures:
        words = sig.split(" ") if sig else []
        group = leaders.setdefault(keys[sig], [])
        if not any(_similarity(lead, words) >= config.sim_th for _, lead in group):
            group.append((sig, words))
    members = {}
    for sig in signatures:
        words = sig.split(" ") if sig else []
        best, chosen = -1.0, None
        for lead, lead_words in leaders[keys[sig]]:
            score = 2.0 if lead == sig else _similarity(lead_words, words)
            if score > best:
                best, chosen = score, lead
        members.setdefault((keys[sig], chosen), []).append(words)
    out = {}
    for number, (_, group) in enumerate(members.items(), 1):
        template = " ".join(t[0] if len(set(t)) == 1 else WILD for t in zip(*group))
        out.update({" ".join(words): (number, template) for words in group})
    return out


def _table(spark, signatures, parts=3):
    rows = [(s, i % 5 + 1, i) for i, s in enumerate(signatures, 1)]
    df = spark.createDataFrame(rows, "signature string, lines bigint, seen_at bigint")
    return stage(df.repartition(parts), "test-signatures")


def _mined(spark, signatures, config, parts=3):
    dictionary, assignment = mine(_table(spark, signatures, parts), config)
    rows = assignment.join(dictionary.select("event_no", "EventTemplate"), "event_no").collect()
    return {r.signature: (r.event_no, r.EventTemplate) for r in rows}


def _random_signatures(seed, count=300, words=6, vocabulary=4, heads=3):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        length = rng.randint(1, words)
        first = rng.choice([f"h{'abcdefghijkl'[rng.randrange(heads)]}", "n7", "n8"])
        rest = [rng.choice([WILD, "<NUM>", *(f"w{'abcdef'[v]}" for v in range(vocabulary))]) for _ in range(length - 1)]
        out.append(" ".join([first, *rest]))
    return list(dict.fromkeys(out))


CONFIGS = [
    MiningConfig(batch=3),
    MiningConfig(sim_th=0.7, max_children=3, batch=64),
    MiningConfig(sim_th=0.55, depth=5, max_children=3, batch=5),
    MiningConfig(sim_th=0.5, depth=3, batch=1000),
]


@pytest.mark.parametrize("config", CONFIGS, ids=str)
def test_mining_equals_the_line_by_line_model(spark, config):
    signatures = _random_signatures(config.depth * 10 + config.max_children, heads=8)
    signatures.insert(40, "")
    assert _mined(spark, signatures, config) == model(signatures, config)


def test_leaders_in_several_packs(spark, monkeypatch):
    monkeypatch.setattr("logloom.operators.templates.MAX_UNION", 2)
    signatures = _random_signatures(5, count=120)
    config = MiningConfig(sim_th=0.8, batch=2)
    assert _mined(spark, signatures, config) == model(signatures, config)


def test_no_broadcast_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr("logloom.operators.templates.broadcast_if_small", lambda df, *a, **k: df)
    signatures = _random_signatures(6, count=150)
    assert _mined(spark, signatures, MiningConfig()) == model(signatures, MiningConfig())


def test_partitioning_does_not_matter(spark):
    signatures = _random_signatures(11)
    results = [_mined(spark, signatures, MiningConfig(), parts) for parts in (1, 7, 40)]
    assert results[0] == results[1] == results[2]


def test_wildcard_signatures_end(spark):
    signatures = ["<*> <*> <*>", "<*> <*> a", "<*> b <*>"]
    assert _mined(spark, signatures, MiningConfig()) == model(signatures, MiningConfig())


def test_full_similarity_is_exact_mode(spark):
    signatures = [s for s in _random_signatures(3) if WILD not in s]
    mined = _mined(spark, signatures, MiningConfig(sim_th=1.0))
    assert mined == {s: (i, s) for i, s in enumerate(signatures, 1)}


def test_template_fits_its_lines(spark):
    signatures = _random_signatures(21)
    for sig, (_, template) in _mined(spark, signatures, MiningConfig()).items():
        pairs = list(zip(template.split(" "), sig.split(" "), strict=True))
        assert all(t in (WILD, s) for t, s in pairs)


@pytest.mark.parametrize("pack", [1024, 2])
def test_increment_keeps_ids_and_appends(spark, pack, monkeypatch):
    monkeypatch.setattr("logloom.operators.templates.KNOWN_PACK", pack)
    signatures = _random_signatures(31)
    first, second = signatures[:100], signatures[60:]
    config = MiningConfig()
    dictionary, assignment = mine(_table(spark, first), config)
    before = {r.event_no: r.EventTemplate for r in dictionary.collect()}
    grown, later = mine(_table(spark, second), config, dictionary)
    after = {r.event_no: r.EventTemplate for r in grown.collect()}
    assert set(before) <= set(after)
    assert sorted(after) == list(range(1, len(after) + 1))
    # Texts cover old and new members, and differ from old ones by wildcards only.
    events = [(r.signature, r.event_no) for found in (assignment, later) for r in found.collect()]
    for text, no in [*events, *((t, n) for n, t in before.items())]:
        pairs = zip(after[no].split(" "), text.split(" "), strict=True)
        assert all(new in (WILD, old) for new, old in pairs)
    assert {r.signature for r in later.collect()} == set(second)
    # Leaders of the first run are found again.
    old = {r.signature: r.event_no for r in assignment.collect()}
    new = {r.signature: r.event_no for r in later.collect()}
    leaders = {" ".join(r.leader): r.event_no for r in dictionary.collect()}
    assert all(new[s] == n for s, n in leaders.items() if s in new)
    assert set(old) == set(first)


def test_a_later_member_widens_the_text(spark):
    first = structure(_lines(spark, ["alpha beta gamma delta eps"]), BLOCK_LOG, MiningConfig())
    both = structure(_lines(spark, ["alpha beta gamma OTHER WORD"]), BLOCK_LOG, MiningConfig(), first.dictionary)
    assert [(r.EventId, r.EventTemplate) for r in both.templates.collect()] == [("E1", "alpha beta gamma <*> <*>")]
    assert [r.EventTemplate for r in both.events.collect()] == ["alpha beta gamma <*> <*>"]
    versions = first.dictionary.unionByName(both.dictionary)
    assert [r.EventTemplate for r in current_dictionary(versions).collect()] == ["alpha beta gamma <*> <*>"]


def test_far_sources_and_lines_keep_their_order(spark):
    rows = [
        ("first kind of line one", "a.log", 1, 5),
        ("second sort which differs wholly", "b.log", 1 + 2**24, 5),
        ("third thing", "c.log", 1, 2**40 + 5),
        ("fourth", "d.log", 2**61, 2**61),
    ]
    lines = spark.createDataFrame(rows, "value string, source string, source_order bigint, LineId bigint")
    for mining in (None, MiningConfig()):
        events = structure(lines, BLOCK_LOG, mining).events.collect()
        assert {(r.source, r.EventId, r.EventTemplate) for r in events} == {
            ("a.log", "E1", rows[0][0]), ("c.log", "E2", rows[2][0]), ("b.log", "E3", rows[1][0]), ("d.log", "E4", rows[3][0])
        }
        assert len(events) == 4


def _lines(spark, values):
    rows = [(v, "a.log", 1, i) for i, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "value string, source string, source_order bigint, LineId bigint")


def test_every_line_gets_one_event_and_occurrences_add_up(spark):
    values = [f"Receiving block blk_{i} src: /10.0.0.{i}:50010" if i % 3 else f"Deleting block blk_{i}" for i in range(90)]
    for mining in (None, MiningConfig()):
        result = structure(_lines(spark, values + ["", " "]), BLOCK_LOG, mining)
        assert result.events.filter("EventId is not null").count() == 90
        assert result.templates.agg(F.sum("Occurrences")).first()[0] == 90
        assert {r.EventTemplate for r in result.templates.collect()} == {
            "Deleting block <BLOCK>",
            "Receiving block <BLOCK> src: /<IP><NUM>",
        }


def test_without_masks_digit_tokens_are_wildcards(spark):
    values = [f"Receiving block blk_{i} src: /10.0.0.{i}:50010" for i in range(20)]
    result = structure(_lines(spark, values), BLOCK_LOG, MiningConfig(), masks=())
    assert [r.EventTemplate for r in result.templates.collect()] == ["Receiving block <*> src: <*>"]


def _free_text(count, seed=3):
    """Lines of one leaf that hardly repeat: words by a steep distribution."""
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return list(dict.fromkeys(" ".join(["start", *rng.choices(words, weights, k=11)]) for _ in range(count)))


def test_index_rounds_do_not_grow_with_leaders(spark, monkeypatch):
    from logloom.operators import templates as T

    labels, real = [], T.stage
    monkeypatch.setattr(T, "stage", lambda df, label, *a: labels.append((label, real(df, label, *a))) or labels[-1][1])
    config, rounds, work = MiningConfig(sim_th=0.6, batch=8), [], []
    for count in (150, 1500):
        labels.clear()
        signatures = _free_text(count)
        mined = _mined(spark, signatures, config)
        rounds.append(sum(label == "open" for label, _ in labels))
        # Candidates that were compared: pairs under the items of all signatures and leaders.
        items = next(df for label, df in labels if label == "own-items").select(F.explode("items").alias("item"))
        led = next(df for label, df in labels if label == "leader-items").select(F.explode("items").alias("item"))
        work.append(items.join(led, "item").count())
        if count == 150:
            assert mined == model(signatures, config)
    # Ten times the leaders, and the rounds stay; the comparisons grow less than the square would.
    assert len({n for n, _ in mined.values()}) > 1000
    assert rounds[1] <= rounds[0] + 2
    assert work[1] < 100 * work[0] and work[1] < 0.1 * 1500**2


def test_index_holds_every_similar_pair(spark):
    from logloom.operators.templates import _indexed, assign_leaves

    for sim_th in (0.0, 0.3, 0.4, 0.75, 1.0):
        config = MiningConfig(sim_th=sim_th, max_children=3)
        signatures = _random_signatures(17, count=200, words=9)
        rows = _indexed(assign_leaves(_table(spark, signatures), config), config).collect()
        found = [(r.n_tokens, tuple(r.heads), r["tokens"], set(r["items"])) for r in rows]
        for i, a in enumerate(found):
            for b in found[:i]:
                if a[:2] == b[:2] and _similarity(a[2], b[2]) >= sim_th and a[2] != b[2]:
                    assert a[3] & b[3]


def test_known_signatures_are_not_mined_again(spark, monkeypatch):
    """A leader's own signature takes its event; with no other signature no leaf is looked at, and new ones are numbered on."""
    schema = "signature string, lines bigint, seen_at bigint"
    first = [("open file a now", 2, 1), ("stop", 1, 2), ("<*> <*>", 1, 3), ("open file b now", 1, 4)]
    known, assigned = T.mine(stage(spark.createDataFrame(first, schema), "signatures"), MiningConfig())
    before = {r.signature: r.event_no for r in assigned.collect()}
    again = [("stop", 5, 10), ("<*> <*>", 1, 11), ("open file a now", 1, 12)]
    mixed = [*again, ("open file b now", 1, 13), ("open file c now", 1, 14), ("a new one", 1, 15)]
    _, assigned = T.mine(stage(spark.createDataFrame(mixed, schema), "signatures"), MiningConfig(), known)
    found = {r.signature: r.event_no for r in assigned.collect()}
    assert {x: found[x] for x in before} == before and found["open file c now"] == before["open file a now"]
    assert found["a new one"] == max(before.values()) + 1 and len(found) == 6

    def looked_at(*_):
        raise AssertionError("mined again")

    monkeypatch.setattr(T, "assign_leaves", looked_at)
    dictionary, assigned = T.mine(stage(spark.createDataFrame(again, schema), "signatures"), MiningConfig(), known)
    assert {r.signature: (r.event_no, r.EventId) for r in assigned.collect()} == {x: (before[x], f"E{before[x]}") for x, *_ in again}
    assert sorted(map(str, dictionary.collect())) == sorted(map(str, known.collect()))


def test_texts_compare_only_larger_groups_by_position(spark):
    rows = [(1, 5, ["a", "b"]), (1, 4, ["a", "c"]), (2, 7, ["x", WILD]), (3, 9, []), (4, 2, [])]
    grouped = stage(spark.createDataFrame(rows, "leader_seen bigint, seen_at bigint, tokens array<string>"), "test-grouped")
    texts = T.template_texts(grouped, "leader_seen")
    assert {tuple(r) for r in texts.collect()} == {(1, f"a {WILD}", 4), (2, f"x {WILD}", 7), (3, "", 9), (4, "", 2)}
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    # Read from the top: positions are listed above the join that leaves out groups of one.
    assert "LeftSemi" in plan[plan.index("Generate") :]


def test_rounds_leave_one_open_table(spark):
    from pathlib import Path

    from logloom.session import new_dir

    words = [" ".join(f"w{(i * k) % 7}q" for k in range(1, 9)) for i in range(7)] + [" ".join(["p"] * k + ["z"] * (8 - k)) for k in range(8)]
    config = MiningConfig(sim_th=0.6)
    leaves = stage(T.assign_leaves(_table(spark, words), config), "test-leaves")

    def held() -> set:
        return {x for kind in ("open", "heads") for x in Path(new_dir(spark, "x")).parent.glob(f"{kind}-*")}

    before = held()
    parts = T._by_index(leaves, config)
    assert sum(part.count() for part in parts) > 2
    # The last one, which is empty.
    assert len(held() - before) == 1
