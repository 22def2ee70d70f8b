"""N-gram Jaccard join: near-duplicate documents by their word shingles, without losing a link.

Every document is the sorted array of the 63-bit hashes of its distinct shingles. Two documents
link when the arrays overlap in at least t of their union. The join runs in three steps:

1. Tiles by least shingle. Documents whose least hash (under either of two orders) agrees meet in a
   tile, sorted by size. Within a tile only pairs of sizes that can reach t are compared: parity
   bitmaps bound the overlap from above (bits in which two bitmaps differ are at least as many
   shingles in which the sets differ), and survivors are intersected exactly. Pairs that are
   connected already are skipped, so a large group of copies costs a pass, not its square.
2. Components of these links.
3. Prefix join. Documents with overlap t share one of their first n - ceil(t n) + 1 shingles under
   any common order. Shingles come in the order of how many sets of all tasks hold them, counted
   in buckets, so a passage that many documents share comes behind what they have of their own. Only
   documents of different components are paired; bitmaps and exact intersection decide again.

Step 3 alone finds every link; step 1 makes it cheap. Equal sets are collapsed before both, first
per task. The counts only change the order and thus the cost, never the result.

Contract: A-Z are lower-cased, words are runs of characters other than space, TAB, LF, VT, FF and
CR. With fewer words than a shingle has, the whole sequence is one shingle; without words (or text) the
set is empty and links with nothing. Null ids are kept as rows and come last as component ids.
Every row gives a row; repeated rows link. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.llm.memory import Memo, at_work, lean, slices, small_batches
from logloom.session import broadcast_if_small, stage

WORDS = 5
# Overlap times DEN >= union times NUM.
NUM, DEN = 80, 100
BITS = 4096
# Rows of a tile that are compared at once, and bytes of their sets; a larger set is a tile's only addition.
TILE_ROWS = 2048
TILE_BYTES = 24 << 20
# Sets of a block of candidate pairs, and their bytes; a tile holds two blocks.
BLOCK_ROWS = 512
BLOCK_BYTES = 12 << 20
# Bytes of text or sets that a task works on at a time.
STEP_BYTES = 4 << 20
# Buckets that shingles are counted in to tell common ones, pages they are gathered in, and tasks that add them up.
COMMON_MOST = 1 << 21
COUNT_PAGE, COUNT_TASKS = 1 << 15, 32
# A bitmap of so many bits (4 MB) spares sets that meet nothing a shuffle; pages it is gathered in.
FILTER_BITS = 1 << 25
FILTER_PAGE = 1 << 15
# Bytes of words and their hashes that a worker remembers.
MEMO_BYTES = 64 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * _MIX[3]
    x = (x ^ (x >> np.uint64(32))) * _MIX[3]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted shingle hashes of texts; words are remembered."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, Memo(MEMO_BYTES)

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The shingles of every text."""
        split = [[w for w in (x or "").encode().translate(_LOWER).split(b" ") if w] for x in texts]
        for word in self.known.missing(set().union(*split)):
            self.known.put(word, xxhash.xxh3_64_intdigest(word), 40)
        young = self.known.young
        found = [self._of(np.fromiter(map(young.__getitem__, x), np.uint64, len(x))) for x in split]
        self.known.settle()
        return found

    def shingles(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]

    def _of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return hashes.view(np.int64)
        width = min(self.words, len(hashes))
        rows = np.full(len(hashes) - width + 1, width, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(width):
                rows = mixed(rows * _MIX[0] + hashes[i : i + len(rows)])
        # The sign bit stays clear, so signed and unsigned order agree.
        return np.unique(rows >> np.uint64(1)).view(np.int64)


def least_overlap(a: np.ndarray, b: int) -> np.ndarray:
    """The least overlap of sizes a and b that links: o DEN >= (a + b - o) NUM."""
    return -(-(a + b) * NUM // (DEN + NUM))


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap: a bit says whether an odd number of hashes fell on it."""
    odd = np.bincount(hashes & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def fold(maps: np.ndarray, bits: int) -> np.ndarray:
    """The same bitmaps with fewer bits; halves are added by exclusive or."""
    while maps.shape[1] * 64 > bits:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def bits_for(size: int, most: int = BITS) -> int:
    """About one bit per shingle, a power of two from 64 on."""
    return min(most, max(64, 1 << int(size).bit_length()))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Exact size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Forest:
    """Union-find over small integers, roots smallest."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def roots(self) -> np.ndarray:
        while True:
            new = self.up[self.up]
            if (new == self.up).all():
                return new
            self.up = new

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def tile_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is linked within a tile; every link that is left out is implied."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    forest, links = Forest(len(order)), []
    maps: dict[int, np.ndarray] = {}
    for at in range(1, len(order)):
        size = int(sizes[at])
        low = int(np.searchsorted(sizes[:at], -(-size * NUM // DEN)))
        if low == at:
            continue
        bits = bits_for(size)
        if bits not in maps:
            maps[bits] = np.stack([bitmap(sets[i], bits) for i in order])
        # Nearest sizes first; whatever joins the document's own component is skipped.
        left = np.arange(low, at)
        need = least_overlap(sizes[left], size)
        differ = np.bitwise_count(maps[bits][left] ^ maps[bits][at]).sum(1, dtype=np.int64)
        left = left[(sizes[left] + size - differ) // 2 >= need]
        while len(left):
            other = int(left[-1])
            if overlap(sets[order[other]], sets[order[at]]) >= least_overlap(sizes[other], size):
                forest.join(other, at)
                links.append((order[other], order[at]))
                roots = forest.roots()
                left = left[roots[left] != roots[at]]
            else:
                left = left[:-1]
    return links


# Rows: one per document (kind 0), one per set that is new in its task (1, with a node number,
# the least shingles under two orders, and the sorted hashes), one per page of counts (2, high: page).
_SHINGLED = "kind int, doc_id bigint, node bigint, n bigint, high bigint, low bigint, keys array<bigint>, hashes binary"


def _print(hashes: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (digest >> 65), (digest & ((1 << 63) - 1))


def least_keys(hashes: np.ndarray) -> list[int]:
    """The least shingle under two independent orders."""
    with np.errstate(over="ignore"):
        other = mixed(hashes.view(np.uint64) + _MIX[1])
    return [int(hashes[0]), ~int(hashes[other.argmin()])]


def _shingle(batches: Iterator[pa.RecordBatch], words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    with at_work(Shingler, words) as shingler:
        yield from _shingle_with(shingler, batches, buckets)


def _shingle_with(shingler: Shingler, batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    seen, counts = set(), np.zeros(buckets, np.uint32)
    context = TaskContext.get()
    node = (context.partitionId() if context else 0) << 33
    names = [x.split()[0] for x in _SHINGLED.split(", ")]
    kinds = (pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.binary())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for part in slices(batch, "text", STEP_BYTES):
            rows, held = [], []
            for doc_id, hashes in zip(part.column("doc_id").to_pylist(), shingler.many(part.column("text").to_pylist())):
                high, low = _print(hashes)
                rows.append((0, doc_id, None, len(hashes), high, low, None, None))
                if len(hashes) and (high, low) not in seen:
                    seen.add((high, low))
                    rows.append((1, None, node, len(hashes), high, low, least_keys(hashes), hashes.tobytes()))
                    node += 1
                    held.append(hashes)
            if held:
                found, times = np.unique(np.concatenate(held) % buckets, return_counts=True)
                counts[found] += times.astype(np.uint32)
            if rows:
                yield out(rows)
    pages = [(i, np.minimum(counts[at : at + COUNT_PAGE], 255).astype(np.uint8)) for i, at in enumerate(range(0, buckets, COUNT_PAGE))]
    if rows := [(2, None, None, None, i, None, None, zlib.compress(page.tobytes(), 1)) for i, page in pages if page.any()]:
        yield out(rows)


def prefix_size(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def _prefix(batches: Iterator[pa.RecordBatch], levels: Broadcast, filled: Broadcast, hit: bool) -> Iterator[pa.RecordBatch]:
    """(node, n, prefix) of the rows whose bit is set, or of those whose bit is not.

    A prefix is the first shingles by level of their bucket, then by hash.
    """
    level = levels.value
    for whole in batches:
        rows = whole.filter(pa.array(_set_bits(filled.value, whole.column("bit").to_numpy()) == hit))
        yield from _prefixes(rows, level)


def _prefixes(rows: pa.RecordBatch, level: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in slices(rows, "hashes", STEP_BYTES):
        prefixes = []
        for hashes in batch.column("hashes"):
            own = _values(hashes)
            order = np.argsort(level[own % len(level)], kind="stable")
            prefixes.append(own[order[: prefix_size(len(own))]])
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("n"), pa.array(prefixes, pa.list_(pa.int64()))], ["node", "n", "prefix"]
        )


def _tiles(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, n): links within every key, in tiles of at most ``rows`` sets.

    The last set of a tile opens the next one, so what agrees is chained across tiles.
    """
    key, nodes, sets, used = None, [], [], 0

    def out() -> Iterator[pa.RecordBatch]:
        links = tile_links(sets) if len(sets) > 1 else []
        if links:
            u, v = ([nodes[x[i]] for x in links] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        for now, node, hashes in zip(batch.column("key").to_pylist(), batch.column("node").to_pylist(), batch.column("hashes")):
            if now != key:
                yield from out()
                key, nodes, sets, used = now, [], [], 0
            elif len(sets) >= rows or used >= TILE_BYTES:
                yield from out()
                nodes, sets = nodes[-1:], sets[-1:]
                used = sets[0].nbytes
            nodes.append(node)
            sets.append(_values(hashes))
            used += sets[-1].nbytes
    yield from out()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (shingle, size): pairs of different components that can link.

    ``apart`` is the node less its component, ``spot`` the size times 2^32 plus the place of the
    shingle in the order: columns that compress.

    Of all shingles that two sets share, the first in the common order bounds their overlap by
    what follows it in either set; a pair that is left out here shows under that shingle.
    """
    names = ("shingle", "node", "apart", "spot")
    rest = np.zeros((0, len(names)), np.int64)

    def out(run: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, nodes, apart, spots = run.T
        groups, sizes, places = nodes - apart, spots >> 32, spots & 0xFFFFFFFF
        if (groups == groups[0]).all():
            return
        behind = sizes - places
        u, v, held = [], [], 0
        for at in range(1, len(run)):
            low = int(np.searchsorted(sizes[:at], -(-sizes[at] * NUM // DEN)))
            need = least_overlap(sizes[low:at], int(sizes[at]))
            able = (groups[low:at] != groups[at]) & (np.minimum(behind[low:at], behind[at]) >= need)
            left = nodes[low:at][able]
            if len(left):
                u.append(np.minimum(left, nodes[at]))
                v.append(np.maximum(left, nodes[at]))
                held += len(left)
            if held > 100_000 or (held and at == len(run) - 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])
                u, v, held = [], [], 0

    for batch in batches:
        rows = np.concatenate([rest, np.stack([batch.column(x).to_numpy() for x in names], 1)])
        starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        ends = np.append(starts[1:], len(rows))
        several = np.flatnonzero(ends[:-1] - starts[:-1] > 1)
        for i in several:
            yield from out(rows[starts[i] : ends[i]])
        rest = rows[starts[-1] :]
    if len(rest) > 1:
        yield from out(rest)


def _values(hashes: pa.Scalar) -> np.ndarray:
    return np.frombuffer(hashes.as_py(), np.int64)


def _payloads(hashes: pa.Array, as_maps: bool) -> pa.Array:
    """Sets as they are, or as parity bitmaps behind their sizes, two to four bits per shingle."""
    if not as_maps:
        return hashes
    payload = []
    for raw in hashes:
        own = _values(raw)
        payload.append(np.int64(len(own)).tobytes() + bitmap(own, 2 * bits_for(len(own))).tobytes())
    return pa.array(payload, pa.binary())


def able_by_maps(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sizes and bitmaps leave room for a link."""
    n, m, one, two = int(a[0]), int(b[0]), a[1:].view(np.uint64), b[1:].view(np.uint64)
    bits = 64 * min(len(one), len(two))
    differ = int(np.bitwise_count(fold(one[None, :], bits) ^ fold(two[None, :], bits)).sum())
    return (n + m - differ) // 2 >= int(least_overlap(np.int64(n), m))


def able_exactly(a: np.ndarray, b: np.ndarray) -> bool:
    return overlap(a, b) >= int(least_overlap(np.int64(len(a)), len(b)))


def _check(batches: Iterator[pa.RecordBatch], able: Callable[[np.ndarray, np.ndarray], bool]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (tile, payloads first): the pairs of a tile that pass."""
    tile, held = None, {}
    for batch in batches:
        u, v = [], []
        payloads = batch.column("payload")
        for i, (now, a, b) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("tile", "u", "v")))):
            if now != tile:
                tile, held = now, {}
            if b is None:
                held[a] = _values(payloads[i])
            elif able(held[a], held[b]):
                u.append(a)
                v.append(b)
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _passing(payloads: DataFrame, placed: DataFrame, able: Callable) -> DataFrame:
    """The placed pairs (tile, u, v) that pass; a payload is sent once per tile that needs it."""
    wanted = placed.select("tile", F.explode(F.array("u", "v")).alias("node")).distinct()
    rows = wanted.join(payloads, "node").select("tile", F.col("node").alias("u"), F.lit(None).cast("bigint").alias("v"), "payload")
    rows = rows.union(placed.select("tile", "u", "v", F.lit(None).cast("binary")))
    dealt = rows.repartition("tile").sortWithinPartitions("tile", F.col("v").isNotNull())
    return dealt.mapInArrow(lean(partial(_check, able=able)), "u bigint, v bigint")


def _verified(sets: DataFrame, pairs: DataFrame, block_rows: int) -> DataFrame:
    """The links among ``pairs`` (u < v), checked in tiles.

    Sets with the same least partner are likely partners of each other: they form blocks of at
    most about ``block_rows``, and the pairs of two blocks a tile. A set is sent once per tile
    that it has a pair in, not once per pair.
    """
    ends = pairs.select("u", F.explode(F.array("u", "v")).alias("node"))
    least = ends.groupBy("node").agg(F.min("u").alias("label")).join(sets.select("node", "n"), "node")
    parts = F.ceil(F.greatest(F.count("*") / block_rows, F.sum(F.col("n") * 8) / BLOCK_BYTES)).cast("bigint")
    sizes = least.groupBy("label").agg(parts.alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    blocks = stage(least.join(sizes, "label").select("node", F.xxhash64("label", part).alias("block")), "blocks")
    placed = pairs.join(blocks.select(F.col("node").alias("u"), F.col("block").alias("block_u")), "u")
    placed = placed.join(blocks.select(F.col("node").alias("v"), F.col("block").alias("block_v")), "v")
    tile = F.xxhash64(F.least("block_u", "block_v"), F.greatest("block_u", "block_v"))
    placed = stage(placed.select(tile.alias("tile"), "u", "v"), "placed-pairs")
    # Bitmaps are small and rule most pairs out; sets are only sent for the others.
    maps = _spared(sets, [F.col("node")], blocks.select("node"), as_maps=True).select("node", "payload")
    left = stage(_passing(maps, placed, able_by_maps), "sifted-pairs")
    again = placed.join(left, ["u", "v"]).select("tile", "u", "v")
    ends = left.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    own = _spared(sets, [F.col("node")], ends).select("node", "payload")
    return _passing(own, again, able_exactly)


def _add_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the counts of every page."""
    pages: dict[int, np.ndarray] = {}
    for batch in batches:
        for page, counts in zip(batch.column("page").to_pylist(), batch.column("counts")):
            own = np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
            pages[page] = pages.get(page, np.uint32(0)) + own.astype(np.uint32)
    for page, counts in pages.items():
        yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([counts.tobytes()], pa.binary())], ["page", "counts"])


def shingle_levels(found: DataFrame, buckets: int) -> np.ndarray:
    """How many sets of all tasks hold shingles of every bucket, as 2047 times its logarithm.

    Its size does not depend on the rows. It only orders shingles; what it says of a single one may be too much.
    """
    pages = found.filter("kind = 2").select(F.col("high").alias("page"), F.col("hashes").alias("counts"))
    counts = np.zeros(buckets, np.uint32)
    for row in pages.repartition(COUNT_TASKS, "page").mapInArrow(_add_pages, "page bigint, counts binary").toLocalIterator():
        own = np.frombuffer(row["counts"], np.uint32)
        counts[row["page"] * COUNT_PAGE :][: len(own)] = own
    return (2047 * np.log2(1.0 + counts)).astype(np.uint16)


def shingled(docs: DataFrame, words: int = WORDS, buckets: int = COMMON_MOST) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stage(rows.mapInArrow(partial(_shingle, words=words, buckets=buckets), _SHINGLED), "shingles")


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of a task in pages that hold any."""
    pages: dict[int, np.ndarray] = {}
    for batch in batches:
        bits = batch.column("bit").to_numpy()
        for page in np.unique(bits // FILTER_PAGE):
            held = pages.setdefault(int(page), np.zeros(FILTER_PAGE, bool))
            held[bits[bits // FILTER_PAGE == page] % FILTER_PAGE] = True
    for page, held in pages.items():
        yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["page", "bits"])


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits with a bit for every key: false hits happen, misses don't.

    Its size does not depend on the keys. It only spares rows a shuffle; joins decide.
    """
    bits = keys.select(_bit(F.col(keys.columns[0])).alias("bit")).distinct()
    pages = bits.repartition(FILTER_BITS // FILTER_PAGE // 16, F.floor(F.col("bit") / FILTER_PAGE))
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in pages.mapInArrow(_bits, "page bigint, bits binary").toLocalIterator():
        found[row["page"] * FILTER_PAGE // 8 : (row["page"] + 1) * FILTER_PAGE // 8] |= np.frombuffer(row["bits"], np.uint8)
    return found


def _set_bits(filled: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the bits are set."""
    return ((filled[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1).astype(bool)


def _bit(key: Column) -> Column:
    """The bit of a key in a bitmap of ``_filter_of``."""
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def _hit(batches: Iterator[pa.RecordBatch], filled: Broadcast, as_maps: bool) -> Iterator[pa.RecordBatch]:
    """(node, n, payload, places) of the rows any of whose bits is set; places are the keys whose bits are."""
    for batch in (part for whole in batches for part in slices(whole, "hashes", STEP_BYTES)):
        bits = batch.column("bits")
        flat, size = bits.flatten().to_numpy(), len(bits)
        hit = _set_bits(filled.value, flat)
        hits = hit.reshape(size, -1) if size else hit.reshape(0, 1)
        some = hits.any(1)
        left = batch.filter(pa.array(some))
        keys = left.column("keys").to_pylist()
        places = [[key for key, met in zip(own, at) if met] for own, at in zip(keys, hits[some].tolist())]
        columns = [left.column("node"), left.column("n"), _payloads(left.column("hashes"), as_maps), pa.array(places, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["node", "n", "payload", "places"])


def _spared(sets: DataFrame, keys: list, wanted: DataFrame, as_maps: bool = False) -> DataFrame:
    """(node, n, payload, places) of the sets any of whose ``keys`` may be in ``wanted``; places are these keys."""
    filled = sets.sparkSession.sparkContext.broadcast(_filter_of(wanted))
    bits = F.array(*[_bit(key) for key in keys]).alias("bits")
    schema = "node bigint, n bigint, payload binary, places array<bigint>"
    return sets.select("node", "n", "hashes", F.array(*keys).alias("keys"), bits).mapInArrow(lean(partial(_hit, filled=filled, as_maps=as_maps)), schema)


def prefix_tokens(sets: DataFrame, groups: DataFrame, levels: np.ndarray) -> DataFrame:
    """(shingle, node, apart, spot) of every shingle of every prefix, see ``_pairs``.

    Only sets that may stand in ``groups`` (node, component) are shuffled to meet it, the others are components of their own.
    """
    context = sets.sparkSession.sparkContext
    level, filled = context.broadcast(levels), context.broadcast(_filter_of(groups.select("node")))
    rows = sets.select("node", "n", "hashes", _bit(F.col("node")).alias("bit"))
    alone, met = (
        rows.mapInArrow(lean(partial(_prefix, levels=level, filled=filled, hit=hit)), "node bigint, n bigint, prefix array<bigint>") for hit in (False, True)
    )
    met = met.join(groups, "node", "left").select("node", "n", "prefix", (F.col("node") - F.coalesce("component", "node")).alias("apart"))
    placed = alone.withColumn("apart", F.lit(0).cast("bigint")).unionByName(met)
    tokens = placed.select("node", "n", "apart", F.posexplode("prefix").alias("place", "shingle"))
    return tokens.select("shingle", "node", "apart", (F.shiftleft("n", 32) + F.col("place")).alias("spot"))


def jaccard_links(sets: DataFrame, levels: np.ndarray, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v) of (node, n, keys, hashes): links that connect exactly the components of all links.

    ``levels`` orders shingles by their bucket, see ``shingle_levels``.
    """
    keyed = sets.select("node", F.explode("keys").alias("key"))
    several = stage(keyed.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1"), "shared-keys")
    # A set goes to its tiles by its own keys, so it is sent once for each and meets no table on the way.
    able = _spared(sets, [F.get("keys", F.lit(i)) for i in range(2)], several.select("key"))
    able = able.select("node", "n", F.col("payload").alias("hashes"), F.explode("places").alias("key"))
    # A key with many sets is spread over tiles, over others under the other order.
    large = several.filter(F.col("held") > tile_rows).select("key", F.ceil(F.col("held") / tile_rows).cast("bigint").alias("parts"))
    spread = F.pmod(F.xxhash64("node", "key"), F.coalesce("parts", F.lit(1))).alias("spread")
    tiles = able.join(broadcast_if_small(large), "key", "left").select("node", "n", "hashes", "key", spread)
    dealt = tiles.repartition("key", "spread").sortWithinPartitions("key", "spread", "n")
    dealt = dealt.select(F.xxhash64("key", "spread").alias("key"), "node", "hashes")
    near = stage(dealt.mapInArrow(lean(partial(_tiles, rows=2 * tile_rows)), "u bigint, v bigint"), "tile-links")
    groups = connected_components(near)
    met = prefix_tokens(sets, groups, levels).repartition("shingle").sortWithinPartitions("shingle", "spot")
    pairs = stage(met.mapInArrow(lean(_pairs), "u bigint, v bigint").distinct(), "pairs")
    return near.union(stage(_verified(sets, pairs, BLOCK_ROWS), "far-links"))


def jaccard_components(docs: DataFrame, words: int = WORDS, tile_rows: int = TILE_ROWS, common_most: int = COMMON_MOST) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Common shingles are told by counts in ``common_most`` buckets.
    """
    # Whole texts and sets go to the workers in these steps, and all of them run at once.
    with small_batches(docs.sparkSession):
        found = shingled(docs, words, common_most)
        links = jaccard_links(found.filter("kind = 1").select("node", "n", "keys", "hashes"), shingle_levels(found, common_most), tile_rows)
    prints = found.filter("kind = 0").select("doc_id", "n", "high", "low")
    # A set may stand in several tasks; its copies link like any others, and the least node names it.
    met = found.filter("kind = 1")
    nodes = met.groupBy("high", "low").agg(F.min("node").alias("node"))
    groups = connected_components(links)
    known = nodes.join(groups, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component"))
    # Least document per set, then per component, so that a set of very many copies combines per task.
    least = prints.filter("n > 0").groupBy("high", "low").agg(F.min("doc_id").alias("least")).join(known, ["high", "low"])
    final = least.join(least.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    final = final.select("high", "low", "component_id")
    return prints.join(final, ["high", "low"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is that of their component, with all their columns.

    A document is its id: of rows that share one the largest text stays, then the greater one. Rows without an id can't be told
    apart by it and all stay. Columns of any name pass; an empty table gives an empty one.
    """
    kept = jaccard_components(docs).filter("doc_id = component_id").select("doc_id").distinct()
    ids = docs.select(F.col("doc_id").cast("bigint").alias("id"))
    # Ids of several rows are few, and only their rows are compared.
    several = stage(ids.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1 AND id IS NOT NULL").select("id"), "repeated-ids")
    own = docs.filter(F.col("doc_id").isNotNull())
    own = own.alias("d").join(kept.alias("k"), F.col("d.doc_id").cast("bigint") == F.col("k.doc_id"), "left_semi")
    if not several.isEmpty():
        same = F.col("d.doc_id").cast("bigint") == F.col("s.id")
        rows = own.alias("d").join(several.alias("s"), same, "left_semi")
        size = F.struct(F.length(F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit("")))
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = rows.select(F.col("doc_id").cast("bigint").alias("id"), size.alias("size"), row.alias("row")).groupBy("id").agg(F.max_by("row", "size").alias("row"))
        one = first.select([F.col("row").getField(c).alias(c) for c in docs.columns])
        own = own.alias("d").join(several.alias("s"), same, "left_anti").unionByName(one)
    return own.unionByName(docs.filter(F.col("doc_id").isNull()))
