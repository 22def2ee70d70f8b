"""Two tokenizers side by side: groups of tokens between common ends, and links weighed over the corpus.

Copies of a text are tokenised once: documents are grouped by their full text (combined per task
before the shuffle), every distinct text is encoded and aligned by itself, and the counts of its
linked id pairs are weighed with the number of its copies. Measures go back to documents by a
join on the text's digest.

Two tokens are linked when their byte ranges end together; the common ends cut both sequences into
groups. Corpus counts are sums per id pair. The most frequent pairs, of bounded number, are sent to
the tasks that look links up; links of rarer pairs, where there are any, meet their counts in a
shuffle.

Text is cut before single spaces between two other characters that are no white space. A
byte-level pre-tokenizer cuts there, and so does a piece vocabulary none of whose pieces has a space after
another character (checked when it is read; else texts are encoded whole). Both tokenizers thus end a token there, so a chunk is
aligned by itself and remembered. The same holds between a word of letters and a mark behind it that no piece joins to a letter.

Contract: side A encodes space + text, side B encodes text and adds the space itself; special
tokens inside texts are plain text. Texts that are null or empty, or whose joined token bytes differ
from space + text on either side, have no tokens: all measures 0 and an empty ``groups_sha256``. A
link counts as best if no id pair with its B id is more frequent in the corpus. Repeated rows
give repeated results; an empty table gives an empty result. Null ids are kept. Columns besides
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from logloom.llm.byte_bpe import cut
from logloom.llm.memory import Memo, at_work, slices
from logloom.session import broadcast_if_small, stage

# Bytes of remembered chunks (two generations of half that) and of the longest one.
MEMO_BYTES = 160 << 20
MEMO_CHARS = 48
# Id pairs whose counts are sent to every task, at most.
HOT_PAIRS = 1_000_000
# Bytes of text whose chunks are encoded together.
STEP_BYTES = 2 << 20

_ALIGNED = "digest string, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"

# Groups as text, links as A id << 32 | B id in bytes, and the numbers of A and B tokens, A << 32 | B, in bytes.
Chunk = tuple[str, bytes, bytes]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    """The bytes of a piece: a byte token's own byte, else its text with spaces."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


def _added(one: bytes, other: bytes) -> bytes:
    return (int.from_bytes(one, "little") + int.from_bytes(other, "little")).to_bytes(8, "little")


class Aligner:
    """Encodes texts with both tokenizers and aligns them, chunk by chunk."""

    def __init__(self, a_path: str, b_path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        added = self.a.get_added_tokens_decoder()
        a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = token.encode() if i in added else bytes(map(alphabet.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [piece_bytes(p, self.b.is_byte(i)) for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_sizes, self.b_sizes = ([len(x) for x in t] for t in (a_bytes, b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(t))] for t in (a_bytes, b_bytes))
        self.by_chunk = not any("▁" in p.lstrip("▁") for p in pieces)
        self.memo = Memo(memo_bytes)
        cut_apart = self.a.pre_tokenizer.pre_tokenize_str if self.a.pre_tokenizer else None
        joined = {p[i + 1] for p in pieces for i in range(len(p) - 1) if p[i].isalpha()}
        self.marks: dict[str, Chunk] = {}
        for mark in ".,;:!?)":
            if self.by_chunk and cut_apart and mark not in joined and len(cut_apart(" ab" + mark)) == 2:
                a, b = self.a.encode(mark, add_special_tokens=False).ids, self.b.encode("ab" + mark)[len(self.b.encode("ab")) :]
                if chunk := self.align(mark.encode(), a, b):
                    self.marks[mark] = chunk

    def align(self, raw: bytes, a: list[int], b: list[int]) -> Chunk | None:
        """Groups and links of the two encodings of ``raw``; None where one does not give it back."""
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a_sizes, b_sizes, a_names, b_names = self.a_sizes, self.b_sizes, self.a_names, self.b_names
        groups, links = [], []
        i = j = from_a = from_b = 0
        a_end, b_end = a_sizes[a[0]], b_sizes[b[0]]
        # Both sides end at the same byte, so neither runs out before the other.
        while True:
            if a_end == b_end:
                x, y = a[i], b[j]
                links.append(x << 32 | y)
                left = a_names[x] if i == from_a else ",".join([a_names[k] for k in a[from_a : i + 1]])
                right = b_names[y] if j == from_b else ",".join([b_names[k] for k in b[from_b : j + 1]])
                groups.append(left + "|" + right)
                i, j = i + 1, j + 1
                if i == len(a):
                    return ";".join(groups), array("q", links).tobytes(), (i << 32 | j).to_bytes(8, "little")
                from_a, from_b = i, j
                a_end += a_sizes[a[i]]
                b_end += b_sizes[b[j]]
            elif a_end < b_end:
                i += 1
                a_end += a_sizes[a[i]]
            else:
                j += 1
                b_end += b_sizes[b[j]]

    def _code(self, chunks: list[str]) -> list[Chunk | None]:
        """Chunks, each of which starts with a space that side B adds by itself."""
        a = self.a.encode_batch_fast(chunks, add_special_tokens=False)
        b = self.b.encode([x[1:] for x in chunks], num_threads=1)
        return [self.align(chunk.encode(), x.ids, y) for chunk, x, y in zip(chunks, a, b)]

    def _learn(self, names: set[str]) -> list[str]:
        """Remember what is new among ``names``; returns it."""
        marked, plain = [], []
        for name in self.memo.missing(names):
            (marked if name[-1] in self.marks and name[1:-1].isalpha() and name[0] == " " else plain).append(name)
        plain += self.memo.missing({x[:-1] for x in marked}).difference(plain)
        for at in range(0, len(plain), 8192):
            part = plain[at : at + 8192]
            for name, chunk in zip(part, self._code(part)):
                self.memo.put(name, chunk, self._size(chunk))
        for name in marked:
            word, mark = self.memo.young[name[:-1]], self.marks[name[-1]]
            chunk = word and (word[0] + ";" + mark[0], word[1] + mark[1], _added(word[2], mark[2]))
            self.memo.put(name, chunk, self._size(chunk))
        return plain + marked

    @staticmethod
    def _size(chunk: Chunk | None) -> int:
        return 200 + len(chunk[0]) + len(chunk[1]) if chunk else 0

    def texts(self, texts: list[str]) -> list[list[Chunk] | None]:
        """The aligned chunks of every text, none of which is empty; None where a side does not give the text back."""
        split = [cut(" " + x) if self.by_chunk else [" " + x] for x in texts]
        names = set().union(*split)
        learned = self._learn(names)
        # A small table of what these texts hold stays in the cache of the processor.
        known = dict(zip(names, map(self.memo.young.__getitem__, names)))
        found = [list(map(known.__getitem__, chunks)) for chunks in split]
        # Long chunks do not come again.
        for name in learned:
            if len(name) > MEMO_CHARS:
                self.memo.drop(name, self._size(self.memo.young[name]))
        self.memo.settle()
        wrong = None in known.values()
        return [None if wrong and None in chunks else chunks for chunks in found]


def _align(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    with at_work(Aligner, a_path, b_path) as aligner:
        names = [x.split()[0] for x in _ALIGNED.split(", ")]
        kinds = (pa.string(), *[pa.int64()] * 5, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                texts = batch.column("text").to_pylist()
                rows = []
                for text, copies, chunks in zip(texts, batch.column("copies").to_pylist(), aligner.texts(texts)):
                    digest = hashlib.sha256(text.encode()).hexdigest()
                    if chunks is None:
                        rows.append((digest, copies, 0, 0, 0, 0, "", [], []))
                        continue
                    links = np.sort(np.frombuffer(b"".join([x[1] for x in chunks]), np.int64))
                    firsts = np.flatnonzero(np.diff(links, prepend=-1))
                    times = np.diff(firsts, append=len(links))
                    counts = np.frombuffer(b"".join([x[2] for x in chunks]), np.int64)
                    a, b = int((counts >> 32).sum()), int((counts & 0xFFFFFFFF).sum())
                    groups = hashlib.sha256(";".join([x[0] for x in chunks]).encode()).hexdigest()
                    rows.append((digest, copies, a, b, len(links), len(links), groups, links[firsts], times))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per distinct text: its digest, copies, measures, groups and linked id pairs with their times."""
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies"))
    return distinct.mapInArrow(partial(_align, a_path=a_path, b_path=b_path), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best) over the corpus; ``best``: no pair with this B id is more frequent."""
    links = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    weight = F.col("link.times").cast("bigint") * F.col("copies")
    counts = links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(weight).alias("n"))
    counts = stage(counts, "pair-counts")
    side = F.col("pair").bitwiseAND(F.lit(2**32 - 1))
    highest = counts.groupBy(side.alias("b")).agg(F.max("n").alias("highest"))
    # At most one row per id of side B.
    joined = counts.withColumn("b", side).join(broadcast_if_small(highest), "b")
    return joined.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _hot_from(counts: DataFrame, most: int) -> int:
    """The least count from which on at most ``most`` pairs are as frequent; found by powers of two."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    # At most 63 rows.
    held = {r["level"]: r["pairs"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("pairs")).collect()}
    total, least = 0, 64
    for step in sorted(held, reverse=True):
        total += held[step]
        if total > most:
            break
        least = step
    return least


def link_measures(aligned: DataFrame, counts: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(digest, n_best, count_sum) of every distinct text with links. ``counts`` is read several times."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    least = _hot_from(counts, hot_pairs)
    hot = F.broadcast(counts.filter(level >= least))
    links = aligned.select("digest", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "digest", F.col("link.pairs").alias("pair"), F.col("link.times").cast("bigint").alias("times")
    )
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best")
    total = F.sum(F.col("times") * F.col("n")).alias("count_sum")
    found = links.join(hot, "pair").groupBy("digest").agg(best, total)
    rare = counts.filter(level < least)
    if rare.isEmpty():
        return found
    # Pairs that are not sent: their links meet them by a shuffle, after the frequent ones are gone.
    others = links.join(hot, "pair", "left_anti").join(rare, "pair").groupBy("digest").agg(best, total)
    both = found.unionByName(others).groupBy("digest")
    return both.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    aligned = stage(align_texts(docs, a_path, b_path), "aligned")
    counts = stage(pair_counts(aligned), "counts")
    measured = link_measures(aligned, counts, hot_pairs)
    plain = aligned.select("digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    texts = stage(plain.join(measured, "digest", "left"), "measured")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(F.col("text") != "", F.sha2(F.col("text").cast("string"), 256)).alias("digest"),
    )
    numbers = [F.coalesce(x, F.lit(0).cast("bigint")).alias(x) for x in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return rows.join(texts, "digest", "left").select("doc_id", *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
