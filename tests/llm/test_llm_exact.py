"""Exact duplicates, tries, the byte-pair encoder and the pipeline's contract."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from logloom.llm.byte_bpe import encode_documents, round_trip, vocabulary
from logloom.llm.exact_dedup import Trie, exact_dedup, keep_distinct, owners, rank

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

DOCS = [
    (1, "a b", "x"), (2, "ab", "y"), (3, "a\tb ", "z"), (4, None, "x"), (5, "", "x"), (6, " \n", "x"), (7, "ab ", "x"),
    (3, "a\tb ", "z"), (None, "ab", "n"), (8, "long " * 5000, "x"), (9, "long " * 5000, "y"),
]
SCHEMA = "doc_id bigint, text string, kept string"


def _bodies(rows):
    return ["".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r") for _, t, _ in rows]


def test_owners_equal_brute_force(spark):
    found = exact_dedup(spark.createDataFrame(DOCS, SCHEMA)).collect()
    bodies = _bodies(DOCS)
    want = []
    for (doc_id, _, _), body in zip(DOCS, bodies):
        group = [(-len(t or ""), i is None, i or 0) for (i, t, _), b in zip(DOCS, bodies) if b == body]
        best = min(group)
        want.append((doc_id, None if best[1] else best[2], len(group)))
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == sorted(want, key=str)
    # One row of every group stays, also where rows are repeated.
    assert sum(r.kept for r in found) == len(set(bodies))
    assert {r.keep_id for r in found if r.kept} == {r.keep_id for r in found}


def test_spilled_subtrees_give_the_same(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(1, 9))), "") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = exact_dedup(df).orderBy("doc_id").collect()
    assert exact_dedup(df, trie_bytes=40_000, collapse_bytes=4000).orderBy("doc_id").collect() == whole


def test_trie_spills_what_is_heavy_and_keeps_the_rest():
    trie = Trie(budget=1)
    words = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ab"]
    for i, word in enumerate(words):
        assert trie.insert(word, rank(1, i, i), 1, [i], 0) is None
    assert {k: e[1] for k, e in trie.walk()} == {b"": 1, b"a": 1, b"ab": 2, b"abc": 1, b"abd": 1, b"b": 1}
    spilled = []
    while cut := trie.spill():
        spilled += [k for k, _ in cut[1]]
        assert trie.insert(spilled[-1], rank(1, 9, 9), 1, [9], 0) is not None
    # One text is left, and every text is in one place.
    rest = [k for k, _ in trie.walk()]
    assert len(rest) == 1 and sorted(spilled + rest) == sorted(set(words))
    assert list(owners(iter([]))) == []


def test_kept_rows_have_all_columns(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    kept = keep_distinct(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.kept) for r in kept.collect()) == [(3, "z"), (4, "x"), (7, "x"), (8, "x")] or len(kept.collect()) == 4


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(empty).count() == 0
    assert keep_distinct(empty).count() == 0
    assert round_trip(empty, PATH, public_tokenizers.PATTERN).count() == 0


@pytest.fixture(scope="module")
def pairs():
    return vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(pairs):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abthe ingr\n\t\r é本1!'s\x1c\x85　\U0001f600"), max_size=80))
def test_ids_are_those_of_the_library(pairs, library, text):
    ids = pairs.encode(text)
    assert ids == library.encode_ordinary(text)
    assert pairs.decode(ids) == text.encode()


def test_long_pieces(pairs, library):
    for text in ("a" * 20000, " " * 20000, "ab" * 9000, "\n" * 3001 + " x", "the" * 4000):
        assert pairs.encode(text) == library.encode_ordinary(text)


def test_documents_are_encoded(spark, library):
    rows = [(1, "Hello, wörld  now\n\n ok"), (2, None), (2, ""), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = encode_documents(df, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in found) == sorted((str(i), library.encode_ordinary(t or "")) for i, t in rows)
    empty = round_trip(df.filter("text IS NULL"), PATH, public_tokenizers.PATTERN).first()
    assert empty.n_tokens == 0 and empty.ids_sha256 == empty.decoded_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
