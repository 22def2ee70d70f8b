"""Exact deduplication with Patricia tries.

Rows are first collapsed per task (equal bodies meet in a dictionary of bounded size), so a text
that a third of all rows share leaves every task once per flush. The collapsed texts are staged,
dealt out by length and content hash, and inserted as full byte strings into one compressed radix
trie per task. A terminal holds the best row of its text. A trie that outgrows its budget spills
heavy subtrees, and later texts of these, to the shared folder; a next round takes them up.

Contract: null text counts as empty. Texts are equal when they are identical after deleting
space, TAB, LF, VT, FF and CR. The row with the most code points in the original text stays, then
the smallest doc_id (null last), then the row met first: of rows that agree in everything exactly
one stays. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import stage

WHITE = " \t\n\x0b\x0c\r"
# Bytes of distinct texts that a task collapses at once, and that one trie keeps.
COLLAPSE_BYTES = 16 * 1024 * 1024
TRIE_BYTES = 96 * 1024 * 1024
# What a node costs besides its label.
NODE_BYTES = 400

_GROUP = (
    "gid bigint, n_bytes bigint, content_hash bigint, text_sha256 string, body binary, best_n bigint, "
    "best_id bigint, size bigint, members array<bigint>, best_at int"
)
_OWNER = (
    "spilled boolean, refs array<bigint>, best_gid bigint, best_n bigint, best_id bigint, size bigint, "
    "n_bytes bigint, content_hash bigint, body binary"
)


class Node:
    """``label`` leads here from the parent; ``entry`` is set where a text ends."""

    __slots__ = ("children", "entry", "label", "spilled")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.entry: list | None = None
        self.spilled: int | None = None


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def rank(n: int, doc_id: int | None, gid: int) -> tuple:
    """Sorts the row that stays first."""
    return (-n, doc_id is None, doc_id or 0, gid)


class Trie:
    """A compressed radix trie from byte strings to entries ``[rank, size, refs, hash]``."""

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.used, self._spills = Node(b""), budget, 0, 0

    def insert(self, key: bytes, best: tuple, size: int, refs: list[int], content_hash: int) -> int | None:
        """Merge one text; the number of the spilled subtree it belongs to, if any."""
        node, at = self.root, 0
        while True:
            if node.spilled is not None:
                return node.spilled
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.used += NODE_BYTES + len(key) - at
            elif not key.startswith(child.label, at):
                cut = _shared(child.label, key, at)
                middle = node.children[key[at]] = Node(child.label[:cut])
                child.label = child.label[cut:]
                middle.children[child.label[0]] = child
                self.used += NODE_BYTES
                child = middle
            node, at = child, at + len(child.label)
        if node.entry is None:
            node.entry = [best, size, refs, content_hash]
        else:
            entry = node.entry
            entry[0] = min(entry[0], best)
            entry[1] += size
            entry[2] = entry[2] + refs
        self.used += 8 * len(refs)
        return None

    def walk(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, list]]:
        stack = [(node or self.root, prefix)]
        while stack:
            node, path = stack.pop()
            if node.entry is not None:
                yield path, node.entry
            stack += [(x, path + x.label) for x in node.children.values()]

    def _weights(self) -> dict[int, int]:
        """Bytes below every node, by identity, without recursion."""
        order, weights = [self.root], {}
        for node in order:
            order += node.children.values()
        for node in reversed(order):
            refs = 8 * len(node.entry[2]) if node.entry else 0
            weights[id(node)] = NODE_BYTES + len(node.label) + refs + sum(weights[id(x)] for x in node.children.values())
        return weights

    def spill(self) -> tuple[int, list[tuple[bytes, list]]] | None:
        """Cut off the heaviest subtree that leaves something behind: its number and its texts."""
        weights, node, prefix, left = self._weights(), self.root, b"", False
        while True:
            held = [x for x in node.children.values() if x.spilled is None]
            if not held:
                return None
            heavy = max(held, key=lambda x: weights[id(x)])
            alone = len(held) == 1 and node.entry is None and not left
            left = left or len(held) > 1 or node.entry is not None
            # Not more than about an eighth of the budget at a time, so that most stays.
            if not alone and (weights[id(heavy)] <= self.budget / 8 or all(x.spilled is not None for x in heavy.children.values())):
                break
            node, prefix = heavy, prefix + heavy.label
        texts = list(self.walk(heavy, prefix + heavy.label))
        number = self._spills = self._spills + 1
        heavy.children, heavy.entry = {}, None
        # A text may leave the path inside the label; only its first byte marks the subtree.
        heavy.label, heavy.spilled = heavy.label[:1], number
        self.used -= weights[id(heavy)]
        return number, texts


def collapse(batches: Iterator[pa.RecordBatch], limit: int = COLLAPSE_BYTES) -> Iterator[pa.RecordBatch]:
    """Equal bodies of a task become one row with their members, in windows of ``limit`` bytes."""
    context = TaskContext.get()
    following = (context.partitionId() if context else 0) << 33
    groups: dict[bytes, list] = {}
    held = 0
    names = [x.split()[0] for x in _GROUP.split(", ")]

    def flush() -> pa.RecordBatch:
        nonlocal following
        rows = []
        for body, (sha, content_hash, members, (n, doc_id, at)) in groups.items():
            rows.append((following, len(body), content_hash, sha, body, n, doc_id, len(members), members, at))
            following += 1
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("doc_id", "n", "body", "content_hash", "text_sha256"))
        for doc_id, n, body, content_hash, sha in zip(*columns):
            group = groups.get(body)
            if group is None:
                groups[body] = [sha, content_hash, [doc_id], (n, doc_id, 0)]
                held += len(body) + NODE_BYTES
            else:
                members = group[2]
                best = group[3]
                if rank(n, doc_id, len(members)) < rank(*best):
                    group[3] = (n, doc_id, len(members))
                members.append(doc_id)
                held += 16
            if held >= limit:
                yield flush()
                groups, held = {}, 0
    if groups:
        yield flush()


def owners(batches: Iterator[pa.RecordBatch], budget: int = TRIE_BYTES) -> Iterator[pa.RecordBatch]:
    """Owners of the texts of a task, and the texts of spilled subtrees for the next round."""
    trie = Trie(budget)
    names = [x.split()[0] for x in _OWNER.split(", ")]
    kinds = (pa.bool_(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def row(body: bytes, entry: list, spilled: bool) -> tuple:
        (minus_n, no_id, doc_id, gid), size, refs, content_hash = entry
        return (spilled, refs, gid, -minus_n, None if no_id else doc_id, size, len(body), content_hash, body if spilled else None)

    for batch in batches:
        spilled = []
        for x in batch.to_pylist():
            best = rank(x["best_n"], x["best_id"], x["best_gid"])
            subtree = trie.insert(x["body"], best, x["size"], x["refs"], x["content_hash"])
            if subtree is not None:
                spilled.append(row(x["body"], [best, x["size"], x["refs"], x["content_hash"]], True))
            while trie.used > trie.budget and (cut := trie.spill()):
                spilled += [row(body, entry, True) for body, entry in cut[1]]
        if spilled:
            yield out(spilled)
    rows = []
    for body, entry in trie.walk():
        rows.append(row(body, entry, False))
        if len(rows) == 10_000:
            yield out(rows)
            rows = []
    if rows:
        yield out(rows)


def body_of(text: F.Column) -> F.Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def exact_dedup(docs: DataFrame, trie_bytes: int = TRIE_BYTES, collapse_bytes: int = COLLAPSE_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``."""
    body = body_of(F.col("text")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n"),
        body.alias("body"),
    ).withColumns({"content_hash": F.xxhash64("body"), "text_sha256": F.sha2("body", 256)})
    groups = stage(rows.mapInArrow(partial(collapse, limit=collapse_bytes), _GROUP), "dedup-texts")
    left = groups.select(
        "n_bytes", "content_hash", "body", "best_n", "best_id", "size",
        F.col("gid").alias("best_gid"), F.array("gid").alias("refs"),
    )
    found = None
    while True:
        dealt = left.repartition("n_bytes", "content_hash")
        done = stage(dealt.mapInArrow(partial(owners, budget=trie_bytes), _OWNER), "dedup-owners")
        own = done.filter("NOT spilled").select(
            F.explode("refs").alias("gid"), "best_gid", F.col("best_id").alias("keep_id"), F.col("size").alias("group_size")
        )
        found = own if found is None else found.unionByName(own)
        left = done.filter("spilled")
        if left.isEmpty():
            break
    members = groups.select("gid", "text_sha256", "best_at", "best_n", "members").join(found, "gid")
    return members.select(
        "gid", "best_gid", "best_at", "keep_id", "group_size", "text_sha256", F.posexplode("members").alias("at", "doc_id")
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("gid") == F.col("best_gid")) & (F.col("at") == F.col("best_at"))).alias("kept"),
        "text_sha256",
    )


def keep_distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row is found again by doc_id, body and length; of rows that agree in these one stays.
    """
    found = exact_dedup(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc"),
        F.sha2(body_of(F.col("text")), 256).alias("body"),
        F.length(F.coalesce("text", F.lit(""))).alias("n"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    kept = keyed.join(found, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("body") == F.col("text_sha256")), "left_semi")
    first = kept.groupBy("doc", "body").agg(F.max_by("row", "n").alias("row"))
    return first.select([F.col("row").getField(c).alias(c) for c in docs.columns])
