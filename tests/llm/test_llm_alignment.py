"""Aligned tokens against whole texts encoded by the libraries."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from logloom.llm.memory import Memo
from logloom.llm.token_alignment import Aligner, align_documents, align_texts, pair_counts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, digest string, pairs int, n double"


@pytest.fixture(scope="module")
def library():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


@pytest.fixture(scope="module")
def aligner():
    return Aligner(A, B)


def a_bytes(token):
    """The well-known printable alphabet of byte-level vocabularies, built its own way."""
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return bytes(table[c] for c in token)


def b_bytes(b, i):
    piece = b.id_to_piece(i)
    return bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()


def plain(library, text):
    """(A ids, B ids, links as places, groups) of a whole text, or None."""
    a, b = library
    raw = (" " + text).encode()
    a_coded = a.encode(" " + text, add_special_tokens=False)
    a_ids, b_ids = a_coded.ids, b.encode(text)
    a_parts, b_parts = [a_bytes(a.id_to_token(i)) for i in a_ids], [b_bytes(b, i) for i in b_ids]
    if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
        return None

    def ends(parts):
        at, out = 0, []
        for part in parts:
            at += len(part)
            out.append(at)
        return out

    a_ends, b_ends = ends(a_parts), ends(b_parts)
    links = [(x, y) for x, e in enumerate(a_ends) for y, f in enumerate(b_ends) if e == f]
    groups, i, j = [], 0, 0
    for x, y in links:
        groups.append(",".join(map(str, a_ids[i : x + 1])) + "|" + ",".join(map(str, b_ids[j : y + 1])))
        i, j = x + 1, y + 1
    return a_ids, b_ids, links, ";".join(groups)


def brute(library, rows):
    coded = [plain(library, text) if text else None for _, text in rows]
    counts = Counter()
    for found in coded:
        if found:
            counts.update((found[0][x], found[1][y]) for x, y in found[2])
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    want = []
    for (doc_id, _), found in zip(rows, coded):
        if not found:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a_ids, b_ids, links, groups = found
        pairs = [(a_ids[x], b_ids[y]) for x, y in links]
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        digest = hashlib.sha256(groups.encode()).hexdigest()
        want.append((doc_id, len(a_ids), len(b_ids), groups.count(";") + 1, len(links), best, sum(counts[p] for p in pairs), digest))
    return sorted(want, key=str)


ROWS = [
    (1, "Hello wörld, naïve  tests\n\nof 漢字 and \U0001f600!"), (2, None), (3, ""), (4, " "), (5, "<|endoftext|> </s> <0x41> <unk>"), (6, "a ▁ b"),
    (7, "the cat and the hat"), (8, "the cat and the hat"), (7, "the cat and the hat"), (None, "the end"), (9, "\x00\x01 tab\tend "), (10, " lead"),
    (11, "x" * 300), (12, "loremipsumdolor " * 400), (13, "a" * 47 + " " + "b" * 48 + " " + "c" * 49), (15, "one, two; three! (four) five? é. x.. a,b"), (14, "  \x85 \xa0 é́"),
]


def rows_of(found):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted((tuple(r[x] for x in names) for r in found.collect()), key=str)


def test_equal_to_whole_texts(spark, library):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in ROWS], SCHEMA).repartition(3)
    want = brute(library, ROWS)
    assert rows_of(align_documents(df, A, B)) == want
    assert {r[0] for r in want if r[7] == ""} == {2, 3, 6}


def test_pairs_that_are_not_sent_give_the_same(spark, library):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in ROWS], SCHEMA)
    want = brute(library, ROWS)
    for most in (0, 12):
        assert rows_of(align_documents(df, A, B, hot_pairs=most)) == want


def test_copies_are_tokenised_once_and_weighed(spark):
    df = spark.createDataFrame([(i, "same text", "x", 1, 2.0) for i in range(50)], SCHEMA).repartition(4)
    aligned = align_texts(df, A, B)
    assert [r.copies for r in aligned.collect()] == [50]
    assert {r.n for r in pair_counts(aligned).collect()} == {50}


def test_empty_table(spark):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in ROWS], SCHEMA)
    assert rows_of(align_documents(df.limit(0), A, B)) == []
    assert rows_of(align_documents(df.filter("text IS NULL"), A, B)) == [(2, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abthe ingr\n\t é本1!.,)'s<|>_▁\x1c\x85　\U0001f600"), min_size=1, max_size=80))
def test_chunks_give_what_whole_texts_give(library, aligner, text):
    want, found = plain(library, text), aligner.texts([text])[0]
    assert (want is None) == (found is None)
    if want:
        assert ";".join(x[0] for x in found) == want[3]
        counts = [int.from_bytes(x[2], "little") for x in found]
        assert sum(x >> 32 for x in counts) == len(want[0]) and sum(x & 0xFFFFFFFF for x in counts) == len(want[1])
        linked = [int.from_bytes(x[1][at : at + 8], "little") for x in found for at in range(0, len(x[1]), 8)]
        assert linked == [want[0][x] << 32 | want[1][y] for x, y in want[2]]


def test_long_texts(library, aligner):
    for text in ("a" * 4000, " " * 3000, "ab " * 3000, "漢" * 1500):
        want, found = plain(library, text), aligner.texts([text])[0]
        assert ";".join(x[0] for x in found) == want[3]


def test_memo_is_bounded():
    memo = Memo(100_000)
    for i in range(2000):
        for x in memo.missing({f"w{i}", "often"}):
            memo.put(x, i, 100)
        assert {f"w{i}", "often"} <= set(memo.young)
        memo.settle()
    assert memo.missing({"often"}) == set() and memo.young["often"] == 0 and len(memo.young) + len(memo.old) < 400
