"""Benchmark decontamination: multi-pattern search for item windows with block shift tables.

The alphabet is words. A window is ``WINDOW`` consecutive words of an item; an item with fewer
words, but not none, is one window of its own length. Windows of one length share a searcher: its
shift table says for a block (two neighbouring words) how far the window's end may move on before
a known block can end there, so the words of a clean text are looked at once in nine. Where the
shift is zero, the bucket of that last block holds, by their first words, the places in the items
at which a window with it ends, and the words are compared one by one.

The windows are dealt into parts of bounded size. Every part goes to the workers once and the
documents are scanned against it; with more than one part, the runs of hit words are joined per
document. Documents are never shuffled with their texts, and no pair of document and item is made
that does not share a window.

Contract: words are maximal runs of ASCII letters, digits and characters outside ASCII, with A-Z
lower-cased. A word inside any occurrence of a window is hit. Null and empty texts have no words.
Item texts that are null or have no words are never found; items with equal ids count as one item; an item without
an id hits words but is not counted or named. Repeated documents give repeated rows. An empty
benchmark hits nothing, and an empty document table gives an empty result. Columns besides
``doc_id``, ``item_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.memory import slices
from logloom.session import stage

WINDOW = 10
BLOCK = 2
# Bytes of item text that one part aims at, and words of a segment that long items are cut into.
PART_BYTES = 1 << 20
SEGMENT_WORDS = 1024

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 0x80 or c in _KEEP else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_EMPTY = hashlib.sha256(b"").hexdigest()

_SEGMENTS = "item_id string, words binary"
_FOUND = "doc_id bigint, mark binary, n_words bigint, hits array<bigint>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text: all bytes outside ASCII belong to words."""
    return text.translate(_TABLE).split() if text else []


class Searcher:
    """Windows of ``length`` words: shift table, and buckets by last block and first words."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(BLOCK, length)
        self.longest = length - self.block + 1
        # So many first words tell the windows of a bucket apart.
        self.front = max(self.block, length // 2)
        self.shift: dict[tuple[bytes, ...], int] = {}
        # Last block -> first words -> numbers of windows.
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[int]]] = {}
        # Where a window stands: the words of its segment, and its end in them.
        self.places: list[tuple[list[bytes], int]] = []
        self.items: list[set[str]] = []

    def add(self, words: list[bytes], item: str | None) -> None:
        """All windows of a segment."""
        size, block, front = self.length, self.block, self.front
        for end in range(size, len(words) + 1):
            last, first = tuple(words[end - block : end]), tuple(words[end - size : end - size + front])
            bucket = self.buckets.setdefault(last, {}).setdefault(first, [])
            number = next((n for n in bucket if self._is(n, words, end)), None)
            if number is None:
                number = len(self.places)
                self.places.append((words, end))
                self.items.append(set())
                bucket.append(number)
                for back in range(self.longest):
                    known = tuple(words[end - block - back : end - back])
                    if self.shift.get(known, self.longest) > back:
                        self.shift[known] = back
            if item is not None:
                self.items[number].add(item)

    def _is(self, number: int, words: list[bytes], end: int) -> bool:
        own, at = self.places[number]
        return own[at - self.length : at] == words[end - self.length : end]

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(end, window) of every occurrence in ``words``, by growing end."""
        size, block, front, shift, longest = self.length, self.block, self.front, self.shift.get, self.longest
        end, total = size, len(words)
        while end <= total:
            last = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            step = shift(last, longest)
            if step:
                end += step
                continue
            first = tuple(words[end - size : end - size + front])
            for number in self.buckets[last].get(first, ()):
                if self._is(number, words, end):
                    yield end, number
                    break
            end += 1


class Patterns:
    """The searchers of one part of the benchmark, one per length of window."""

    def __init__(self, segments: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.searchers: dict[int, Searcher] = {}
        for item, text in segments:
            words = text.split()
            length = min(window, len(words))
            if length:
                self.searchers.setdefault(length, Searcher(length)).add(words, item)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words as (start, end), in order and apart, and the items found."""
        spans, items = [], set()
        for length, searcher in self.searchers.items():
            seen = set()
            for end, number in searcher.search(words):
                spans.append((end - length, end))
                if number not in seen:
                    seen.add(number)
                    items |= searcher.items[number]
        return joined(spans), items


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap become one."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            if end > runs[-1][1]:
                runs[-1] = (runs[-1][0], end)
        else:
            runs.append((start, end))
    return runs


def _cut_items(batches: Iterator[pa.RecordBatch], window: int, most: int) -> Iterator[pa.RecordBatch]:
    """Items in segments of at most ``most`` words that share ``window`` - 1 words."""
    for batch in batches:
        rows = []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            last = max(0, len(words) - window)
            for at in range(0, last + 1, most - window + 1):
                if words:
                    rows.append((item, b" ".join(words[at : at + most])))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item_id", "words"])


def _scan(batches: Iterator[pa.RecordBatch], segments: Broadcast, window: int, all_rows: bool) -> Iterator[pa.RecordBatch]:
    patterns = Patterns(segments.value, window)
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
    names = [x.split()[0] for x in _FOUND.split(", ")]
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                runs, items = patterns.hits(words)
                if all_rows or runs:
                    mark = hashlib.sha256(text or b"").digest()
                    rows.append((doc_id, mark, len(words), [x for run in runs for x in run], sorted(items)))
            columns = zip(*rows) if rows else ((),) * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one or more parts to counts and the digest of the items."""
    for batch in batches:
        n_hit, n_items, digests = array("q"), array("q"), []
        for hits, items in zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist()):
            ends = iter(hits)
            n_hit.append(sum(end - start for start, end in joined(list(zip(ends, ends)))))
            names = sorted(set(items))
            n_items.append(len(names))
            digests.append(hashlib.sha256(",".join(names).encode()).hexdigest() if names else _EMPTY)
        hit = pa.array(n_hit, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), hit, pa.array(n_items, pa.int64()), pa.array(digests, pa.string()),
             pa.array([x > 0 for x in n_hit], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, mark, n_words, hits, items) per document; hits are starts and ends of runs in turn.

    ``mark`` is the digest of the text. Runs of different parts may overlap.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).distinct()
    # A segment is never so short that a cut would not move on.
    most = max(SEGMENT_WORDS, 2 * window)
    segments = stage(items.mapInArrow(partial(_cut_items, window=window, most=most), _SEGMENTS).distinct(), "segments")
    size = segments.agg(F.sum(F.octet_length("words") + F.octet_length(F.coalesce("item_id", F.lit(""))))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    placed = segments.withColumn("part", F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)))

    def scan(part: int) -> DataFrame:
        # One part at a time is on the driver: about ``part_bytes``.
        held = [(r["item_id"], bytes(r["words"])) for r in placed.filter(F.col("part") == part).select("item_id", "words").collect()]
        share = spark.sparkContext.broadcast(sorted(held, key=lambda r: (r[0] or "", r[1])))
        return rows.mapInArrow(partial(_scan, segments=share, window=window, all_rows=part == 0), _FOUND)

    found = scan(0)
    if parts == 1:
        return found
    # Equal rows have equal hits, so (doc_id, mark) is key enough; every part is written before the next is sent.
    all_rows = stage(found, "hits")
    more = [stage(scan(part), "hits") for part in range(1, parts)]
    later = more[0]
    for part in more[1:]:
        later = later.unionByName(part)
    later = later.distinct().groupBy("doc_id", "mark").agg(
        F.flatten(F.collect_list("hits")).alias("more_hits"), F.flatten(F.collect_list("items")).alias("more_items")
    )
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.mark") == F.col("b.mark"))
    none = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    return all_rows.alias("a").join(later.alias("b"), same, "left").select(
        "a.doc_id", "a.mark", "n_words",
        F.concat("hits", F.coalesce("more_hits", none[0])).alias("hits"),
        F.concat("items", F.coalesce("more_items", none[1])).alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = benchmark_hits(docs, benchmark, window, part_bytes).select("doc_id", "n_words", "hits", "items")
    schema = T.StructType.fromDDL("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")
    return found.mapInArrow(_measure, schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns; a row stays once per row."""
    spotted = benchmark_hits(docs, benchmark, window).filter(F.size("hits") > 0)
    marks = spotted.select("doc_id", F.lower(F.hex("mark")).alias("mark")).distinct()
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    same = F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("m.doc_id")) & (F.sha2(text, 256) == F.col("m.mark"))
    return docs.alias("d").join(marks.alias("m"), same, "left_anti")
