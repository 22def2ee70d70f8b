"""Vector best-fit packing of token sequences.

Documents are tokenised, closed with an end token and cut into pieces of at most the capacity.
How pieces are packed depends on their lengths only, so packing runs on the histogram of lengths:
at most one count per length, however many documents there are. Lengths are placed from long to
short, all pieces of a length at once, into groups of sequences with equal residual capacities
(tokens, documents, attention cost, the sum of squared lengths). Of the groups that can take a piece under every constraint, the one with
the least weighted residual norm takes it (or the largest weighted dot product of piece and
residual). The plan says which ranks of a length go to which sequences and where; a piece finds its
place by its rank among the pieces of its length, counted in hashed buckets, so that no length,
however frequent, is one task's work.

Contract: null text counts as empty and gives one piece, the end token. Only documents longer
than the capacity are cut; their first piece may be shorter. Every row is packed, repeated rows
too; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer, pre_tokenizers

from logloom.llm.byte_bpe import cut
from logloom.llm.memory import slices, tool
from logloom.session import stage

CAPACITY = 1024
END = 2
# Chunks of text that a worker remembers, and their longest.
MEMO_CHUNKS = 700_000
MEMO_CHARS = 48
# New words that are encoded as one text.
TEXT_WORDS = 32768
# Bytes of text that are encoded together, per remembered chunk.
STEP_BYTES = 6
# Pieces of a length per bucket in which ranks are counted, about.
BUCKET_ROWS = 8192
# A space as the first character of a byte-level token.
SPACE = "\u0120"
# White space that is no single space or line feed between two other characters, or no text at all.
ODD_SPACES = (
    r"\A\z|\A[ \n]|[ \n][ \n]|[ \n]\z|"
    r"[\t\x0b-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Ids of texts as little-endian 32-bit words, by a tokenizer file.

    Text is cut before single spaces between two other characters that are no white space, where
    a byte-level pre-tokenizer always cuts; such chunks are encoded once and remembered. It cuts
    between letters and a mark as well, so a known word with a mark behind it is not encoded again.
    Distinct chunks of a step are looked up once and put together by Arrow.
    """

    def __init__(self, path: str, memo: int = MEMO_CHUNKS):
        self.memo = memo
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Chunks that start with a space, without it; and others.
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        cut_apart = self.tokenizer.pre_tokenizer.pre_tokenize_str if self.tokenizer.pre_tokenizer else None
        apart = [x for x in ".,;:!?)" if cut_apart and len(cut_apart(" ab" + x)) == 2]
        self.marks = dict(zip(apart, self._code(apart)))
        self.opens = self._opening()

    def _opening(self) -> np.ndarray | None:
        """Whether an id's token begins with a space, where only the first of a chunk's tokens can; None for other tokenizers."""
        cutter, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        if not isinstance(cutter, pre_tokenizers.ByteLevel) or not cutter.use_regex or cutter.add_prefix_space or self.tokenizer.normalizer:
            return None
        if any(" " in x.content or x.lstrip or x.rstrip or x.single_word for x in added):
            return None
        vocabulary = self.tokenizer.get_vocab()
        opens = np.zeros(max(vocabulary.values()) + 1, bool)
        opens[[number for token, number in vocabulary.items() if token[:1] == SPACE]] = True
        return opens

    def _code(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [array("I", x.ids).tobytes() for x in coded]

    def _code_words(self, words: list[str]) -> list[bytes]:
        """The ids of words behind a space each: many are encoded as one text, which is cheaper than one by one."""
        return [ids for at in range(0, len(words), TEXT_WORDS) for ids in self._code_text(words[at : at + TEXT_WORDS])]

    def _code_text(self, words: list[str]) -> list[bytes]:
        if self.opens is not None:
            [coded] = self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            starts = np.flatnonzero(self.opens[ids]) * 4
            if len(starts) == len(words):
                raw, starts = ids.astype("<u4").tobytes(), starts.tolist()
                return [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]
        return self._code([" " + x for x in words])

    def _coded(self, known: dict[str, bytes], chunks: pa.Array, code: Callable) -> pa.Array:
        """The ids of every chunk."""
        distinct = chunks.dictionary_encode()
        names = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = list(map(known.get, names))
        missing = [i for i, ids in enumerate(coded) if ids is None]
        if missing:
            new = [names[i] for i in missing]
            marked = [x for x in new if x[-1:] in self.marks and x[:-1].isalpha()]
            plain = list(set(new).difference(marked) | {x[:-1] for x in marked}.difference(known))
            learned = dict(zip(plain, code(plain)))
            for x in marked:
                stem = x[:-1]
                learned[x] = (learned[stem] if stem in learned else known[stem]) + self.marks[x[-1]]
            for i, x in zip(missing, new):
                coded[i] = learned[x]
            if len(known) >= self.memo:
                # The younger half stays: a dict keeps the order in which names came.
                kept = dict(islice(known.items(), len(known) - self.memo // 2, None))
                known.clear()
                known.update(kept)
            known.update([pair for pair in learned.items() if len(pair[0]) <= MEMO_CHARS])
        return pa.array(coded, pa.large_binary()).take(distinct.indices)

    def encode(self, texts: list[str]) -> list[bytes]:
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, ODD_SPACES)
        split = pc.split_pattern(column.filter(pc.invert(odd)), " ")
        words, starts = split.flatten(), split.offsets.to_numpy()
        first = np.zeros(len(words), bool)
        first[starts[:-1]] = True
        firsts = self._coded(self.chunks, words.filter(pa.array(first)), self._code).to_pylist()
        rests = _joined(self._coded(self.words, words.filter(pa.array(~first)), self._code_words), np.diff(starts) - 1)
        cuts = [cut(x) for x in column.filter(odd).to_pylist()]
        others = _joined(self._coded(self.chunks, pa.array(list(chain.from_iterable(cuts)), pa.large_string()), self._code), [len(x) for x in cuts])
        spaced = map(bytes.__add__, firsts, rests)
        return [next(others) if is_odd else next(spaced) for is_odd in odd.to_pylist()]


def _joined(values: pa.Array, sizes: Sequence[int]) -> Iterator[bytes]:
    """The values in runs of ``sizes``, each put together."""
    _, places, data = values.buffers()
    ends = np.frombuffer(places, np.int64, len(values) + 1, 8 * values.offset)[np.cumsum([0, *sizes])] if len(values) else np.zeros(len(sizes) + 1, np.int64)
    whole = memoryview(data or b"")
    return (bytes(whole[a:b]) for a, b in pairwise(ends.tolist()))


def pieces_of(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = tokens - (math.ceil(tokens / capacity) - 1) * capacity
    return [(0, first), *((at, capacity) for at in range(first, tokens, capacity))]


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: int, with_ids: bool, memo: int) -> Iterator[pa.RecordBatch]:
    closing = struct.pack("<I", end)
    names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    coder = tool(Encoder, path, memo)
    for whole in batches:
        for batch in slices(whole, "text", STEP_BYTES * memo):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode([x or "" for x in batch.column("text").to_pylist()])):
                ids += closing
                for number, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, number, start, length, zlib.crc32(part), part)[: len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def cut_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False, memo: int = MEMO_CHUNKS
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if asked for, the ids as bytes.

    A worker remembers about ``memo`` chunks of text: fewer take less memory and more time, and give the same rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = _PIECES + ", ids binary" * with_ids
    return rows.mapInArrow(partial(_cut, path=path, capacity=capacity, end=end, with_ids=with_ids, memo=memo), schema)


def plan_bins(
    counts: dict[int, int],
    capacity: int = CAPACITY,
    most_documents: int | None = None,
    most_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25),
    rule: str = "norm",
) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces, first sequence, offset) for a histogram of lengths.

    Without bounds on documents and attention cost, both follow from the token capacity.
    """
    limits = np.array([capacity, most_documents or capacity, most_attention or capacity**2], np.float64)
    # Open groups: residuals, and the runs (first sequence, size) that have them.
    groups: dict[tuple[int, int, int], list[list[int]]] = {}
    plan, sequences = [], 0
    for length in sorted(counts, reverse=True):
        item = np.array([length, 1, length * length])
        if (item > limits).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        rank, left = 0, counts[length]
        keys = np.array(list(groups), np.int64).reshape(-1, 3)
        keys = keys[(keys >= item).all(1)]
        while left:
            if not len(keys):
                per_bin = int(min(limits // item))
                size = -(-left // per_bin)
                full = tuple(int(x) for x in limits)
                groups[full] = [[sequences, size]]
                sequences += size
                keys = np.array([full])
            share, room = item / limits, keys / limits
            if rule == "norm":
                best = int((weights * (room - share) ** 2).sum(1).argmin())
            else:
                best = int((weights * room * share).sum(1).argmax())
            key = tuple(int(x) for x in keys[best])
            runs = groups[key]
            after = tuple(int(x) for x in keys[best] - item)
            target = groups.setdefault(after, []) if after[0] > 0 and after[1] > 0 and after[2] > 0 else []
            while runs and left:
                first, size = runs[-1]
                used = min(size, left)
                plan.append((length, rank, used, first, capacity - key[0]))
                target.append([first, used])
                rank, left = rank + used, left - used
                if used == size:
                    runs.pop()
                else:
                    runs[-1] = [first + used, size - used]
            if not runs:
                del groups[key]
                keys = np.delete(keys, best, 0)
            if target and (np.array(after) >= item).all() and not (keys == np.array(after)).all(1).any():
                keys = np.concatenate([keys, [after]])
    return plan


def _ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """The pieces with their rank among those of their length, from 0."""
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    held = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = held.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start"))
    return (
        keyed.withColumn("place", place - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("place"))
        .drop("bucket", "place", "before")
    )


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    most_documents: int | None = None,
    most_attention: int | None = None,
    rule: str = "norm",
) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` should be cheap to read: it is read twice."""
    spark: SparkSession = pieces.sparkSession
    # At most one row per length.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins(counts, capacity, most_documents, most_attention, rule=rule)
    schema = "length bigint, first_rank bigint, n bigint, first_sequence bigint, offset bigint"
    # The plan grows with the capacity, not with the pieces.
    slots = F.broadcast(spark.createDataFrame(plan, schema).withColumnRenamed("length", "slot_length"))
    ranked = _ranked(pieces, sum(counts.values()))
    inside = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    sequence = (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id")
    return ranked.join(slots, inside).select(*pieces.columns, sequence, "offset")


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, most_documents: int | None = None,
    most_attention: int | None = None, with_ids: bool = False, memo: int = MEMO_CHUNKS,
) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece."""
    pieces = stage(cut_documents(docs, path, capacity, end, with_ids, memo), "pieces")
    return pack(pieces, capacity, most_documents, most_attention)
