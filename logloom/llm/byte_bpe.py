"""Byte-level BPE in linear time: longest matches in a trie, neighbour checks, and stepping back.

Bytes map to Latin-1 characters, so the trie of an Aho-Corasick automaton over all tokens gives the
longest token at a place of a piece. A piece is walked forward: the longest token that may stand behind the
one before it is taken, then the next shorter token that is a prefix of it; where none is left, the place is dead and the
walk steps back to the token before, which is shortened in turn. Whether two tokens may stand
side by side is decided by undoing their merges (``may_follow``) and remembered for every pair.
A dead place is never entered again and a token has few prefixes that are tokens, so the cost is
linear in the length of a piece, whatever its repeats, and the ids are those of the merge loop.

Contract: null text counts as empty; an empty text has no ids, and the digests of the empty
string. Repeated rows give repeated results, an empty table an empty one; columns besides ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.memory import Memo, at_work, slices, tool

# Chunks up to this many characters are remembered, in so many bytes; and so many answers about pairs.
MEMO_CHARS = 48
MEMO_BYTES = 48 << 20
MEMO_PAIRS = 500_000
# Bytes of text that are encoded together.
STEP_BYTES = 2 << 20

_OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

def single_spaced(text: str) -> bool:
    """Whether all white space is single spaces and line feeds between other characters."""
    words, gaps = text.split(), text.count(" ") + text.count("\n")
    return len(words) == gaps + 1 and sum(map(len, words)) + gaps == len(text)


def cut(text: str) -> list[str]:
    """The text in chunks that start with the space before a word."""
    parts = text.split(" ")
    chunks = [parts[0]]
    touching = not parts[0] or parts[0][-1].isspace()
    for part in parts[1:]:
        if touching or not part or part[0].isspace():
            chunks[-1] += " " + part
        else:
            chunks.append(" " + part)
        touching = not part or part[-1].isspace()
    return [x for x in chunks if x]


class BytePairs:
    """A vocabulary of ``ranks`` (bytes to id; lower ids merge first)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self._build_pairs()
        self.trie = ahocorasick.Automaton()
        # Every path of the trie, and the longest token that it begins with.
        self._paths: dict[str, int] = {}
        texts = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        for text, rank in texts.items():
            self.trie.add_word(text, rank)
            longest = -1
            for end in range(1, len(text) + 1):
                longest = texts.get(text[:end], longest)
                self._paths[text[:end]] = longest
        # For every token the longest other one that it begins with, or -1.
        self._shorter = {rank: self._paths.get(text[:-1], -1) for text, rank in texts.items()}
        self._sizes = {rank: len(token) for token, rank in ranks.items()}
        self._widest = max(map(len, ranks), default=1)
        self._follows: dict[int, bool] = {}
        # Words behind a single space, without it; and other chunks and pieces.
        self._words, self._memo = Memo(2 * MEMO_BYTES), Memo(MEMO_BYTES)
        # Whether the pattern takes a single space to the word behind it, and letters and one mark apart.
        self._spaced = self.find("a b,c 1 'd .") == ["a", " b", ",", "c", " 1", " '", "d", " ."]
        self._marks = {x: self._packed(x) for x in ".,;:!?)" if self.find(f" ab{x}") == [" ab", x]}

    def _build_pairs(self) -> None:
        """``split``: the two ids a token is merged from; ``pair``: the reverse.

        Tokens are taken in rank order; a token that the merge loop can't reach from two earlier
        ones (single bytes among them) is its own split.
        """
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            parts = self.merge(token, rank) if len(token) > 1 else []
            if len(parts) == 2:
                self.split[rank] = (parts[0], parts[1])
                self.pair[parts[0], parts[1]] = rank
            else:
                self.split[rank] = (rank, rank)

    def merge(self, piece: bytes, below: int | None = None) -> list[int]:
        """The merge loop itself, with ranks under ``below``; only for short byte strings."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(
                (rank, i)
                for i in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[i] + parts[i + 1], 1 << 60)) is not None
            )
            if best[0] >= (1 << 60 if below is None else below):
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[x] for x in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side as they are.

        Both are taken apart, last merge first; a merge across the seam that would have come
        before the merges that built them rules the pair out.
        """
        if left < 0:
            return False
        a, b, limit, fine = left, right, 1 << 60, True
        while True:
            across = self.pair.get((a, b))
            if across is not None and across < limit:
                fine = False
                break
            if a > b:
                limit = a
                a = self.split[a][1]
                if a == limit:
                    limit = b + 1
                    b = self.split[b][0]
                    if b + 1 == limit:
                        break
            else:
                limit = b + 1
                b = self.split[b][0]
                if b + 1 == limit:
                    limit = a
                    a = self.split[a][1]
                    if a == limit:
                        break
        self._follows[left << 32 | right] = fine
        return fine

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece: the longest token that may follow, steps back where none does."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        text, size = piece.decode("latin-1"), len(piece)
        longest, paths, follows = self.trie.longest_prefix, self._paths, self._follows
        sizes, shorter, widest = self._sizes, self._shorter, self._widest
        if len(follows) >= MEMO_PAIRS:
            follows.clear()
        dead = bytearray(size + 1)
        path: list[int] = []
        at, left, token = 0, -1, -2
        while True:
            if token == -2:
                token = paths.get(text[at : at + longest(text[at : at + widest])], -1)
            while token >= 0:
                end = at + sizes[token]
                if not dead[end]:
                    if left < 0:
                        break
                    fits = follows.get(left << 32 | token)
                    if fits is None:
                        fits = self.may_follow(left, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                path.append(token)
                if end == size:
                    return tuple(path)
                at, left, token = end, token, -2
            elif path:
                dead[at] = 1
                last = path.pop()
                at -= sizes[last]
                left, token = path[-1] if path else -1, shorter[last]
            else:
                raise ValueError("a byte is missing in the vocabulary")

    def _packed(self, piece: str) -> bytes:
        return array("i", self.encode_piece(piece.encode())).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self._words.young.get(piece[1:]) if piece[0] == " " and self._spaced else self._memo.young.get(piece)
        if ids is None:
            ids = self._packed(piece)
            if piece[0] != " " and len(piece) <= MEMO_CHARS:
                self._memo.put(piece, ids, len(ids))
        return ids

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._piece, self.find(chunk)))

    def _word(self, word: str) -> bytes:
        """The ids of a word behind a space; one of letters, with a mark behind it or not, needs no pattern."""
        if word.isalpha():
            return self._packed(" " + word)
        mark = self._marks.get(word[-1])
        if mark and word[:-1].isalpha():
            return (self._words.young.get(word[:-1]) or self._packed(" " + word[:-1])) + mark
        return self._chunk(" " + word)

    @staticmethod
    def _learn(memo: Memo, names: set[str], code: Callable[[str], bytes]) -> list[str]:
        # Shorter ones first: a word is there when the same word with a mark comes.
        missing = sorted(memo.missing(names), key=len)
        young = memo.young
        for name in missing:
            if name not in young:
                ids = code(name)
                memo.put(name, ids, len(ids))
        return missing

    @staticmethod
    def _settle(memo: Memo, learned: list[str]) -> None:
        """Long names do not come again; they are the last ones."""
        for name in reversed(learned):
            if len(name) <= MEMO_CHARS:
                break
            memo.drop(name, len(memo.young[name]))
        memo.settle()

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """The ids of every text.

        A text is cut before single spaces between two other characters that are no white space,
        where a match of the pattern always ends, so a chunk is coded by itself and remembered.
        """
        split: list[tuple[list[str], list[str]]] = []
        for text in texts:
            if self._spaced and single_spaced(text):
                first, *rest = text.split(" ")
                split.append(([first], rest))
            else:
                split.append((cut(text) if self._spaced else [text] if text else [], []))
        words, chunks = set().union(*[x[1] for x in split]), set().union(*[x[0] for x in split])
        new_words, new_chunks = self._learn(self._words, words, self._word), self._learn(self._memo, chunks, self._chunk)
        # Small tables of what these texts hold stay in the cache of the processor.
        of_word = dict(zip(words, map(self._words.young.__getitem__, words))).__getitem__
        of_chunk = dict(zip(chunks, map(self._memo.young.__getitem__, chunks))).__getitem__
        found = [array("i", b"".join(chain(map(of_chunk, x[0]), map(of_word, x[1])))).tolist() for x in split]
        self._settle(self._words, new_words)
        self._settle(self._memo, new_chunks)
        return found

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file at ``path``: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _vocabulary(path: str, pattern: str) -> BytePairs:
    return BytePairs(read_ranks(path), pattern)


def vocabulary(path: str, pattern: str) -> BytePairs:
    """One vocabulary per Python worker."""
    return tool(_vocabulary, path, pattern)


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    with at_work(_vocabulary, path, pattern) as pairs:
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                ids = pairs.encode_many([x or "" for x in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    with at_work(_vocabulary, path, pattern) as pairs:
        names = [str(rank) for rank in range(max(pairs.tokens, default=-1) + 1)]
        for whole in batches:
            for batch in slices(whole, "text", STEP_BYTES):
                sizes, ids_digests, text_digests = [], [], []
                for ids in pairs.encode_many([x or "" for x in batch.column("text").to_pylist()]):
                    sizes.append(len(ids))
                    ids_digests.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                    text_digests.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
                columns = pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row; each match of ``pattern`` is encoded by itself."""
    return _rows(docs).mapInArrow(partial(_encode, path=path, pattern=pattern), "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, decoded again, and digested."""
    return _rows(docs).mapInArrow(partial(_digests, path=path, pattern=pattern), _OUT)
