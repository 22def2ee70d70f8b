"""Benchmark windows in documents, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from logloom.llm.decontaminate import Patterns, benchmark_hits, clean_documents, decontaminate, joined, words_of

DOCS = "doc_id bigint, text string, hits string, mark int, item_id string, n_words string"
ITEMS = "item_id bigint, text string, doc_id string, part string, words string"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    want = []
    windows = {}
    for item_id, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            if size:
                windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in range(1, window + 1):
            for i in range(len(words) - size + 1):
                names = windows.get(tuple(words[i : i + size]))
                if names:
                    hit |= set(range(i, i + size))
                    found |= {x for x in names if x is not None}
        text = ",".join(sorted(map(str, found)))
        want.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(text.encode()).hexdigest(), bool(hit)))
    return sorted(want, key=str)


def fixture():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["é本", "Ünder", "IT"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 9, 10, 11, 25, 60])))) for i in range(25)]
    items = [x for x in items if len(x[1].split()) != 1] + [(90, "lonely"), (91, None), (92, ""), (93, "?!"), (None, "no name here at all")]
    # Shared windows, equal ids, repeated rows, and an item of one repeated word.
    items += [(94, items[5][1]), (5, "again the same id"), (95, "x " * 40), (96, " ".join(f"v{i}" for i in range(3000)))]
    items.append(items[3])
    docs = []
    for i in range(150):
        body = rng.choices(words, k=rng.randint(0, 80))
        for _ in range(rng.choice([0, 0, 1, 2])):
            part = (rng.choice(items)[1] or "").split()
            start = rng.randrange(max(1, len(part) - 5))
            body[len(body) // 2 : len(body) // 2] = part[start : start + rng.randint(5, 60)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(body).upper() if i % 7 == 0 else rng.choice([" ", ", ", "\n", "-"]).join(body)))
    docs += [(200, None), (201, ""), (202, "..."), (None, "lonely"), (203, "x " * 9), (204, "x " * 500), (205, "say lonely"), docs[3]]
    docs.append((206, " ".join(f"v{i}" for i in range(3000)) + " \x85\xa0 end"))
    docs.append((207, "word " * 200_000 + (items[6][1] or "")))
    return docs, items


def rows_of(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()), key=str)


def tables(spark, docs, items):
    held = spark.createDataFrame([(*r, "h", 1, "i", "n") for r in docs], DOCS)
    return held, spark.createDataFrame([(*r, "d", "p", "w") for r in items], ITEMS)


def test_equal_to_brute_force(spark):
    docs, items = fixture()
    held, tests = tables(spark, docs, items)
    assert rows_of(decontaminate(held.repartition(3), tests)) == brute(docs, items)


def test_many_parts_give_the_same(spark):
    docs, items = fixture()
    held, tests = tables(spark, docs, items)
    assert rows_of(decontaminate(held, tests, part_bytes=2000)) == brute(docs, items)
    assert rows_of(decontaminate(held, tests, window=3, part_bytes=4000)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = fixture()
    held, tests = tables(spark, docs, items)
    assert decontaminate(held.limit(0), tests).count() == 0
    assert rows_of(decontaminate(held, tests.limit(0))) == brute(docs, [])


def test_clean_rows_stay_whole(spark):
    docs, items = fixture()
    held, tests = tables(spark, docs, items)
    kept = clean_documents(held, tests)
    assert kept.columns == held.columns
    marks = [r[0] for r in brute(docs, items) if not r[5]]
    assert sorted(map(str, marks)) == sorted(str(r.doc_id) for r in kept.collect())


def test_shift_table_skips_clean_words():
    rng = random.Random(1)
    item = " ".join(f"t{i}" for i in range(50))
    patterns = Patterns([("1", item.encode())])
    seen = []

    class Words(list):
        def __getitem__(self, at):
            seen.append(at)
            return super().__getitem__(at)

    words = Words(words_of(" ".join(rng.choices("abcdefgh", k=9000)).encode()))
    assert patterns.hits(words) == ([], set())
    # Two words of every block are read, one block in nine words.
    assert len(seen) <= 2 * (9000 // 9 + 1)


def test_runs_join():
    assert joined([(5, 8), (0, 2), (2, 4), (6, 7)]) == [(0, 4), (5, 8)] and joined([]) == []


def test_hits_are_places(spark):
    held, tests = tables(spark, [(1, "a b c d e one two three f")], [(7, "One two, three")])
    row = benchmark_hits(held, tests).first()
    assert list(row.hits) == [5, 8] and list(row["items"]) == ["7"]
