"""N-gram Jaccard join by prefix trees.

A document's set is its distinct word n-grams (64-bit hashes). All sets follow one global order, rare grams first,
by a count sketch over all documents (any order gives the same links; a good one gives few candidates). The sketch has
2 ** 20 counters up to two million documents and grows with them to 2 ** 24, a byte each where it is broadcast.

1. Equal sets collapse into classes, so copies cost nothing further.
2. Prefixes: two sets of overlap o or more share k grams at least among the first n - o + k of each. A class keeps
   the prefix for its own k, 1 + n // 40, and only those grams that another class has too; a class left with fewer
   than any partner would share with it is out. Only class ids and sizes travel with a gram, never the sets.
3. Each class picks one leader, the most central class that shares most of its prefix grams. A leader and a bounded
   number of its followers form a block. In a block the ordered sets are stored in a trie; every set walks it,
   sharing the partial overlaps of common paths, and leaves a subtree when the overlap so far and the remaining
   lengths cannot reach the threshold, or when all sets below already are in its component. Links are exact.
4. Followers of one leader that fill several blocks are joined by what they differ in from the leader: links between its
   component and others share some of that, and a prefix filter over the differences finds them (see ``near_links``).
5. Grams whose classes are not all in one component are, for all other classes, resolved by the same trie walk over pairs
   of cells (bounded groups of classes with one leader) that share enough grams, each pair of cells once.
6. Components are those of all links.

``similarity_components`` stops at the links that join components. ``similarity_links`` finds every link: each pair of
cells that share enough grams (a cell with itself too) is one block, and its trie walk leaves a subtree only by sizes,
overlap and remaining lengths. A pair of classes is in one block alone, so links are counted where they are found and
no table of pairs is written; the work still grows with the number of links, the square of a group of near copies.

No group is ever collected: hot grams are pre-aggregated to their leader, blocks and cells are bounded, and a leader that
is in many blocks is copied to them by as many tasks as it takes. Texts are never shuffled: a Bloom filter of bounded size
over the keys of the wanted classes picks rows where they are read, and their sets alone travel. Classes are told
apart by 128-bit hashes of the sets; their ids are the lower halves, except where two classes have one in common,
which then take the upper ones.

Defined results: null or empty texts, or texts without words, have an empty set, size 0 and link with nothing;
with fewer words than n the whole sequence is the one gram; repeated rows are copies; texts of any length are
read whole; an empty table gives an empty result; extra columns are not carried. A null key takes part, and as
component id it yields to any other key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_arrow, materialize, small_side
from .graph import connected_components

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 18


@dataclass(frozen=True)
class JoinParams:
    words: int = 5
    percent: int = 80
    block: int = 64


#: Least and most bits of the count sketch's index; documents per doubling above the least.
SKETCH_BITS, SKETCH_DOCS = (20, 24), 1_000_000
#: Bits of the Bloom filter for each key, and the most it has (16 MB); beyond that it lets more rows through.
BLOOM_BITS, BLOOM_MOST = 16, 27
#: Copies of a set that one task makes.
COPIES = 64


def least(percent: int, n: int) -> int:
    """ceil(percent / 100 * n)"""
    return -(-percent * n // 100)


def needed(n: int) -> int:
    """How many grams of its prefix a class of n grams asks a partner to share."""
    return 1 + n // 40


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0x9FB21C651E98DF25)
    return x ^ (x >> U64(29))


def _letters() -> np.ndarray:
    """A 64-bit number for each byte; capital letters have those of the small ones."""
    values = _mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
    values[65:91] = values[97:123]
    return values


_LETTER = _letters()
_GAP = np.isin(np.arange(256), [32, *range(9, 14)])


class _Powers:
    """Powers of the base and of its inverse, as many as the longest segment needs."""

    up = down = np.ones(1, U64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, _SEGMENT)
            grow = lambda x: np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, x, U64))])
            cls.up, cls.down = grow(_BASE), grow(_INVERSE)
        return cls.up, cls.down


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word (split at ASCII white space, A-Z as a-z), from prefix sums over segments."""
    raw, out, at = np.frombuffer(data, np.uint8), [], 0
    while at < len(raw):
        end = min(len(raw), at + _SEGMENT)
        if end < len(raw):  # a segment ends at white space
            gaps = np.flatnonzero(_GAP[raw[at:end]])
            later = gaps[-1:] + at if len(gaps) else np.flatnonzero(_GAP[raw[end:]])[:1] + end
            end = int(later[0]) if len(later) else len(raw)
        part = raw[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_GAP[part]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = turns[::2], turns[1::2]
        up, down = _Powers.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(_LETTER[part] * up[: len(part)], out=sums[1:])
        out.append(_mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xA0761D6478BD642F)))
        at = end + (end == at)
    return np.concatenate(out) if out else np.empty(0, U64)


def gram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    h = word_hashes((text or "").encode("utf-8", "replace"))
    if not len(h):
        return h
    width = min(n, len(h))
    grams = np.full(len(h) - width + 1, width * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, U64)
    for i in range(width):
        grams = _mix(grams * U64(0xC2B2AE3D27D4EB4F) + h[i : len(h) - width + 1 + i])
    return np.unique(grams)


def set_ids(grams: np.ndarray) -> tuple[int, int] | tuple[None, None]:
    """Both halves of the set's 128-bit hash."""
    if not len(grams):
        return None, None
    high, low = divmod(xxhash.xxh3_128_intdigest(grams.tobytes()), 1 << 64)
    return low - (1 << 63), high - (1 << 63)


def class_id(grams: np.ndarray, twins: frozenset[int]) -> int | None:
    low, high = set_ids(grams)
    return high if low in twins else low


def _sets(batches: Iterator[pa.RecordBatch], column: int, n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            yield batch, [gram_set(x.as_py(), n) for x in batch.column(column)]


def sketch_bits(documents: int) -> int:
    return min(SKETCH_BITS[1], max(SKETCH_BITS[0], SKETCH_BITS[0] + (documents // SKETCH_DOCS).bit_length() - 1))


def scan_sets(df: DataFrame, params: JoinParams, key: str) -> DataFrame:
    """Pass 1: a row (key, n, sid, check) for each document, and a row (part, sketch) for each partition."""
    n, bits = params.words, sketch_bits(df.count())
    names = ["key", "n", "sid", "check", "part", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind, some = np.zeros(1 << bits, np.uint32), None, False
        for batch, sets in _sets(batches, 1, n):
            kind = batch.column(0).type
            np.add.at(sketch, (np.concatenate(sets) >> U64(64 - bits)).astype(np.int64), 1)
            some = some or any(map(len, sets))
            sids, checks = zip(*map(set_ids, sets), strict=True)
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(sids, pa.int64()), pa.array(checks, pa.int64()), *none], names)
        if some:
            blob = zlib.compress(sketch.tobytes(), 1)
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), part, pa.array([blob], pa.binary())], names)

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(key, "text"), run, f"key {kind}, n int, sid long, check long, part int, sketch binary")


def merged(rows: DataFrame, unite) -> np.ndarray | None:
    """One array of the compressed ones in ``rows`` (part, sketch), all of one fixed size; None where there are none.

    About the square root of their number is united in each task; those results are streamed through the driver.
    """
    groups = max(1, int(rows.count() ** 0.5))

    def united(blobs):
        total = None
        for blob in blobs:
            total = unite(total, zlib.decompress(blob))
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = united(x.as_py() for batch in batches for x in batch.column(1))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["sketch"])

    return united(r.sketch for r in map_arrow(rows.repartition(groups), run, "sketch binary").toLocalIterator())


def _sum(total: np.ndarray | None, data: bytes) -> np.ndarray:
    counts = np.frombuffer(data, np.uint32)
    return counts.copy() if total is None else np.minimum(total.astype(np.uint64) + counts, 0xFFFFFFFF).astype(np.uint32)


def _or(total: np.ndarray | None, data: bytes) -> np.ndarray:
    bits = np.frombuffer(data, np.uint8)
    return bits.copy() if total is None else total | bits


def order_of(scanned: DataFrame) -> np.ndarray:
    """The global order as a byte for each counter of the sketch: eight steps for each doubling of the count."""
    counts = merged(scanned.where("sketch is not null").select("part", "sketch"), _sum)
    if counts is None:
        return np.zeros(1 << SKETCH_BITS[0], np.uint8)
    return np.minimum(8 * np.log2(counts + 1.0), 255).astype(np.uint8)


def _ranks(grams: np.ndarray, order: np.ndarray) -> np.ndarray:
    return order[(grams >> U64(65 - len(order).bit_length())).astype(np.int64)]


def in_order(grams: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The grams in global order: by sketched count, then hash. ``grams`` is sorted by hash."""
    return grams[np.argsort(_ranks(grams, order), kind="stable")]


def prefixes(df: DataFrame, params: JoinParams, counts, twins: frozenset[int]) -> DataFrame:
    """Pass 2: (sid, n, prefix) of each class. Copies combine before and after the shuffle."""
    n, percent = params.words, params.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = counts.value, set()
        for _, sets in _sets(batches, 0, n):
            rows = []
            for s in sets:
                sid = class_id(s, twins)
                if sid is None or sid in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(sid)
                length = len(s) - least(percent, len(s)) + needed(len(s))
                rows.append((sid, len(s), in_order(s, order)[:length].view(np.int64)))
            if rows:
                a, b, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.list_(pa.int64()))], ["sid", "n", "prefix"])

    return map_arrow(df.select("text"), run, "sid long, n int, prefix array<long>").dropDuplicates(["sid"])


def sized(a: str, b: str, percent: int) -> Column:
    """Whether sizes a and b can meet the threshold at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _needed(n: Column) -> Column:
    return 1 + F.floor(n / 40)


def shared_grams(prefix: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(gram, sid, n, degree) of prefix grams in two classes or more, and (gram, leader, leader_n).

    A class whose shared grams are fewer than the least partner in size would ask for is left out.
    """
    rows = prefix.select(F.explode("prefix").alias("gram"), "sid", "n")
    common = materialize(rows.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram"), "grams")
    lists = rows.join(small_side(common, 2_000_000), "gram").groupBy("sid").agg(F.first("n").alias("n"), F.collect_list("gram").alias("grams"))
    lists = lists.where(F.size("grams") >= _needed(F.ceil(F.col("n") * percent / 100)))
    shared = materialize(lists.select(F.explode("grams").alias("gram"), "sid", "n", F.size("grams").alias("degree")), "shared")
    # most central, then a fixed choice among equals; one number, so that the aggregation hashes
    rank = F.least("degree", F.lit(500_000)).cast("long") * (1 << 44) + F.shiftrightunsigned("sid", 20)
    heads = shared.groupBy("gram").agg(F.max_by("sid", rank).alias("leader"), F.max_by("n", rank).alias("leader_n"), F.count("*").alias("c")).where("c > 1").drop("c")
    heads = materialize(heads, "heads")
    discard(common)
    return shared, heads


def leader_votes(shared: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """(sid, leader, n, c): how many of a class's shared grams each leader of a fitting size has."""
    votes = shared.join(heads, "gram").where(F.col("sid") != F.col("leader")).where(sized("n", "leader_n", percent))
    return votes.groupBy("sid", "leader").agg(F.first("n").alias("n"), F.count("*").alias("c"))


def followers(votes: DataFrame) -> DataFrame:
    """(sid, leader): for each class the leader of most of its shared grams."""
    return votes.groupBy("sid").agg(F.max_by("leader", F.least("c", F.lit(500_000)) * (1 << 44) + F.shiftrightunsigned("leader", 20)).alias("leader"))


def gathered(votes: DataFrame, following: DataFrame, params: JoinParams) -> DataFrame:
    """``following``, where a class goes to the leader with most followers, more than one block, that it shares enough grams with,
    so that those of a large group that have changes in common are not dealt to many leaders."""
    popular = materialize(following.groupBy("leader").agg(F.count("*").alias("size")).where(F.col("size") > params.block), "popular")
    able = votes.where(F.col("c") >= _needed(F.col("n"))).join(small_side(popular), "leader")
    moved = able.groupBy("sid").agg(F.max_by("leader", F.least("size", F.lit(500_000)) * (1 << 44) + F.shiftrightunsigned("leader", 20)).alias("other"))
    out = materialize(following.join(moved, "sid", "left").select("sid", F.coalesce("other", "leader").alias("leader")), "gathered")
    discard(popular)
    return out


class Trie:
    """Ordered sets as paths; runs without a branch are one node."""

    __slots__ = ("run", "ends", "below", "children", "shortest", "longest")

    def __init__(self, sets: list[np.ndarray], members: list[int], depth: int):
        """``members`` are sorted by their sets and agree up to ``depth``."""
        first, last = sets[members[0]], sets[members[-1]]
        reach = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:reach] != last[depth:reach])
        end = depth + int(differ[0]) if len(differ) else reach
        self.run, self.below = first[depth:end], np.array(members)
        sizes = [len(sets[m]) for m in members]
        self.shortest, self.longest = min(sizes), max(sizes)
        self.ends = [m for m in members if len(sets[m]) == end]
        self.children: list[Trie] = []
        group: list[int] = []
        for m in members[len(self.ends) :]:
            if group and sets[group[0]][end] != sets[m][end]:
                self.children.append(Trie(sets, group, end))
                group = []
            group.append(m)
        if group:
            self.children.append(Trie(sets, group, end))


def ranked(grams: list[np.ndarray], order: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The sets as sorted places in the block's own global order, and the number of places."""
    universe, places = np.unique(np.concatenate(grams), return_inverse=True)
    ranks = np.empty(len(universe), np.int64)
    ranks[np.argsort(_ranks(universe, order), kind="stable")] = np.arange(len(universe))
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    return [np.sort(x) for x in np.split(ranks[places], cuts)], len(universe)


def trie_links(grams: list[np.ndarray], order: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of similar sets that join the block's components; pairs already joined by others are left out."""
    sets, width = ranked(grams, order)
    root = Trie(sets, sorted(range(len(sets)), key=lambda i: sets[i].tolist()), 0)
    component, links = np.arange(len(sets)), []
    has = np.zeros(width, bool)
    for i, query in enumerate(sets):
        has[query] = True
        size = len(query)
        stack = [(root, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if 100 * min(size, node.longest) < percent * max(size, node.shortest) or (component[node.below] == component[i]).all():
                continue
            if len(node.run):
                overlap += int(np.count_nonzero(has[node.run]))
                depth += len(node.run)
                left = size - int(np.searchsorted(query, node.run[-1], "right"))
            else:
                left = size
            # overlap o of sizes a, b meets the threshold if 100 * o >= percent * (a + b - o)
            if (100 + percent) * (overlap + min(node.longest - depth, left)) < percent * (size + node.shortest):
                continue
            for j in node.ends:
                if component[i] != component[j] and (100 + percent) * overlap >= percent * (size + len(sets[j])):
                    links.append((i, j))
                    component[component == component[j]] = component[i]
            stack.extend((child, overlap, depth) for child in node.children)
        has[query] = False
    return links


def all_trie_links(grams: list[np.ndarray], order: np.ndarray, percent: int, left: int = 0) -> Iterator[tuple[int, int]]:
    """All pairs (i, j) of similar sets, each once. The first ``left`` sets are one side and the rest the other, and
    only pairs of both sides are looked for; without sides (0) all pairs are."""
    sets, width = ranked(grams, order)
    root = Trie(sets, sorted(range(left, len(sets)), key=lambda i: sets[i].tolist()), 0)
    has = np.zeros(width, bool)
    for i in range(left or len(sets)):
        query = sets[i]
        has[query] = True
        size = len(query)
        stack = [(root, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if 100 * min(size, node.longest) < percent * max(size, node.shortest):
                continue
            left_over = size
            if len(node.run):
                overlap += int(np.count_nonzero(has[node.run]))
                depth += len(node.run)
                left_over -= int(np.searchsorted(query, node.run[-1], "right"))
            # overlap o of sizes a, b meets the threshold if 100 * o >= percent * (a + b - o)
            if (100 + percent) * (overlap + min(node.longest - depth, left_over)) < percent * (size + node.shortest):
                continue
            for j in node.ends:
                if j > i and (100 + percent) * overlap >= percent * (size + len(sets[j])):
                    yield i, j
            stack.extend((child, overlap, depth) for child in node.children)
        has[query] = False


def _spots(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The Bloom filter's places of 64-bit hashes."""
    other = _mix(hashes) | U64(1)
    for i in range(4):
        yield (_mix(hashes + U64(i) * other) >> U64(64 - bits)).astype(np.int64)


def bloom_of(wanted: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter, in packed bits, of the column's hashes."""
    bits = min(BLOOM_MOST, max(16, (BLOOM_BITS * wanted.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            for spot in _spots(batch.column(0).to_numpy().view(U64), bits):
                held[spot] = True
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([zlib.compress(np.packbits(held).tobytes(), 1)], pa.binary())], ["part", "sketch"])

    blobs = materialize(map_arrow(wanted.select(F.xxhash64(column).alias("h")), run, "part int, sketch binary"), "bloom")
    found = merged(blobs, _or)
    discard(blobs)
    return np.zeros(1 << bits - 3, np.uint8) if found is None else found


def in_blocks(df: DataFrame, key: str, classes: DataFrame, blocks: DataFrame, params: JoinParams, twins: frozenset[int]) -> DataFrame:
    """(block, side, sid, copies, grams) for each row of ``blocks`` (block, side, sid), grouped and sorted in partitions.

    The texts are read where they lie; a Bloom filter leaves the wanted classes' own documents, whose sets are
    copied to their blocks, at most COPIES of one in a row.
    """
    n, spark = params.words, df.sparkSession
    wanted = blocks.groupBy("sid").agg(F.ceil(F.count("*") / COPIES).cast("int").alias("salts")).join(classes, "sid")
    wanted = materialize(wanted.select("sid", "rep", "copies", "salts"), "wanted")
    salted = small_side(wanted.select("sid", "copies", "salts"), 500_000)
    bloom = spark.sparkContext.broadcast(bloom_of(wanted, "rep"))  # 16 MB at most
    spots = blocks.join(salted, "sid").select("block", "side", "sid", F.pmod(F.xxhash64("block"), F.col("salts")).cast("int").alias("salt"))
    spots = materialize(spots, "places")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = bloom.value, set()
        bits = (len(held) * 8).bit_length() - 1
        for whole in batches:
            hashes, hit = whole.column(0).to_numpy().view(U64), True
            for spot in _spots(hashes, bits):
                hit = hit & (held[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8) & 1).astype(bool)
            for _, sets in _sets([whole.filter(pa.array(hit))], 1, n):
                rows = {}
                for s in sets:
                    sid = class_id(s, twins)
                    if sid is not None and sid not in seen:
                        rows[sid] = s.tobytes()
                        if len(seen) < 500_000:
                            seen.add(sid)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())], ["sid", "grams"])

    sets = map_arrow(df.select(F.xxhash64(key).alias("h"), "text"), read, "sid long, grams binary").join(salted, "sid")
    sets = sets.select("sid", "copies", "grams", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    full = sets.join(small_side(spots, 500_000), ["sid", "salt"]).select("block", "side", "sid", "copies", "grams")
    return full.repartition("block").sortWithinPartitions("block", "side", "sid")


@dataclass
class Block:
    sids: list[int] = field(default_factory=list)
    sides: list[int] = field(default_factory=list)
    copies: list[int] = field(default_factory=list)
    grams: list[np.ndarray] = field(default_factory=list)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of ``in_blocks``'s rows, one at a time."""
    now, block = None, Block()
    for batch in batches:
        for b, side, sid, copies, data in zip(*(batch.column(k).to_pylist() for k in range(4)), batch.column(4), strict=True):
            if b != now:
                if block.sids:
                    yield block
                now, block = b, Block()
            if not block.sids or block.sids[-1] != sid:  # a class may come from several tasks
                block.sids.append(sid)
                block.sides.append(side)
                block.copies.append(copies)
                block.grams.append(np.frombuffer(data.as_py(), U64))
    if block.sids:
        yield block


def join_blocks(sets: DataFrame, counts, params: JoinParams) -> DataFrame:
    """(a, b): links that join components of each block of ``in_blocks``'s rows. Blocks are bounded; a task streams through many."""
    percent = params.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for block in _blocks(batches):
            pairs = trie_links(block.grams, order, percent) if len(block.sids) > 1 else []
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([block.sids[x[k]] for x in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    return map_arrow(sets, run, "a long, b long")


def star_blocks(sets: DataFrame, counts, params: JoinParams) -> DataFrame:
    """The links (a, b) of ``join_blocks`` for blocks of a leader (side 0) and its followers, and a row (a, b, n, base, diff) for each
    follower a that differs from its leader b in no more grams than it has: both sizes, and the grams that one of them has alone."""
    percent = params.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for block in _blocks(batches):
            sids, first = block.sids, block.grams[0]
            rows = [(sids[i], sids[j], None, None, None) for i, j in trie_links(block.grams, order, percent)]
            for sid, grams in zip(sids[1:], block.grams[1:], strict=True):
                diff = np.setxor1d(first, grams, assume_unique=True)
                if len(diff) <= len(grams):
                    rows.append((sid, sids[0], len(grams), len(first), diff.view(np.int64)))
            if rows:
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "b", "n", "base", "diff"])

    return map_arrow(sets, run, "a long, b long, n int, base int, diff array<long>")


def count_blocks(sets: DataFrame, counts, params: JoinParams) -> DataFrame:
    """All links of each block of ``in_blocks``'s rows, as rows (a, b, n): b null, class a has n linked documents in other
    classes of the block; n null, a link that joins components of the block. Side 0 or 1: only pairs of both sides."""
    percent = params.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for block in _blocks(batches):
            sids, copies, left = block.sids, block.copies, block.sides.count(0)
            if len(sids) < 2 or left == len(sids):
                continue
            total, component, rows = [0] * len(sids), np.arange(len(sids)), []
            for i, j in all_trie_links(block.grams, order, percent, left):
                total[i] += copies[j]
                total[j] += copies[i]
                if component[i] != component[j]:
                    rows.append((sids[i], sids[j], None))
                    component[component == component[j]] = component[i]
            rows += [(sid, None, x) for sid, x in zip(sids, total, strict=True) if x]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["a", "b", "n"])

    return map_arrow(sets, run, "a long, b long, n long")


def in_cells(following: DataFrame, params: JoinParams) -> DataFrame:
    """(sid, leader, cell): followers of one leader in groups of about ``params.block``."""
    parts = following.groupBy("leader").agg(F.ceil(F.count("*") / params.block).alias("parts")).where("parts > 1")
    parts = materialize(parts, "parts")
    cells = following.join(small_side(parts), "leader", "left").withColumn("part", F.pmod(F.xxhash64("sid"), F.coalesce("parts", F.lit(1))))
    cells = materialize(cells.select("sid", "leader", F.xxhash64("leader", "part").alias("cell")), "cells")
    discard(parts)
    return cells


def count_links(df: DataFrame, scanned: DataFrame, classes: DataFrame, twins: frozenset[int], params: JoinParams, key: str) -> DataFrame:
    """Rows (a, b, n) of ``count_blocks`` over every pair of cells that may hold a link."""
    spark, percent = df.sparkSession, params.percent
    counts = spark.sparkContext.broadcast(order_of(scanned))  # 16 MB at most
    prefix = materialize(prefixes(df, params, counts, twins), "prefixes")
    shared, heads = shared_grams(prefix, percent)
    discard(prefix)
    cells = in_cells(materialize(followers(leader_votes(shared, heads, percent)), "followers"), params)
    homes = shared.groupBy("sid").agg(F.first("n").alias("n")).join(cells.select("sid", "cell"), "sid", "left")
    homes = materialize(homes.select("sid", "n", F.coalesce("cell", F.xxhash64("sid")).alias("cell")), "homes")
    spots = shared.select("gram", "sid").join(homes, "sid").groupBy("gram", "cell").agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.count("*").alias("c"))
    spots = materialize(spots, "spots")
    other = spots.select("gram", *(F.col(c).alias(f"o_{c}") for c in ("cell", "n_lo", "n_hi")))
    pairs = (
        spots.join(other, "gram")
        .where("cell < o_cell or (cell = o_cell and c > 1)")
        .where(100 * F.col("n_hi") >= percent * F.col("o_n_lo"))
        .where(100 * F.col("o_n_hi") >= percent * F.col("n_lo"))
        .groupBy("cell", "o_cell")
        .agg(F.count("*").alias("c"), F.least(F.min("n_lo"), F.min("o_n_lo")).alias("n"))
        .where(F.col("c") >= _needed(F.col("n")))
    )
    pairs = materialize(pairs.select("cell", "o_cell", F.xxhash64("cell", "o_cell").alias("block")), "cell-pairs")
    # a cell with itself has no sides
    first = pairs.select("block", "cell", F.when(F.col("cell") == F.col("o_cell"), 1).otherwise(0).alias("side"))
    second = pairs.where("cell <> o_cell").select("block", F.col("o_cell").alias("cell"), F.lit(1).alias("side"))
    members = first.unionByName(second).join(homes, "cell").select("block", "side", "sid")
    found = materialize(count_blocks(in_blocks(df, key, classes, members, params, twins), counts, params), "links")
    discard(shared, heads, cells, homes, spots, pairs)
    return found


def near_links(near: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between followers of one leader that are in different components, from ``near`` (sid, leader, n, base, diff,
    label, open), where ``open`` says that the component is not the leader's and ``base`` is the leader's size.

    Two sets that differ from their leader in D and E differ from each other in |D| + |E| - 2 |D & E| grams, at most
    H = (100 - percent) / (100 + percent) * (both sizes) of them if they link. One of the two is open, so it differs from the leader in more than
    H, so D and E share more than half of the other one's: a prefix of about half of E, rarest first, holds a shared one. It is compared with
    the longer prefix of an open set, which has to hold one for any partner; two open sets are compared by halves. Grams that one
    difference alone has come first and are shared with nothing, so copies with changes of their own make no pairs here.
    """
    bound = lambda a, b: F.floor((100 - percent) * (a + b) / (100 + percent))
    grow = F.ceil((100 - percent) * F.greatest(F.col("n") - F.col("base"), F.lit(0)) / (100 + percent))
    d = F.size("diff")
    parts = near.select("sid", "leader", F.explode("diff").alias("gram"))
    common = parts.groupBy("leader", "gram").agg(F.count("*").alias("c")).where("c > 1")
    kept = parts.join(common, ["leader", "gram"]).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("c", "gram"))).alias("common"))
    # the least overlaps asked for: with an open partner, and (of an open set) with any
    asked = near.select("sid", "leader", "label", "open", "n", d.alias("d"), F.ceil((d + 1 - grow) / 2).alias("half"), F.greatest(F.ceil((d - bound(F.col("n"), F.col("base"))) / 2), F.lit(1)).alias("any"))
    asked = asked.join(kept, "sid").withColumn("m", F.size("common"))
    # of the prefix of d - asked + 1 grams, d - m are in no other difference
    asked = asked.withColumn("short", F.col("m") - F.greatest("half", F.lit(1)) + 1).withColumn("long", F.when(F.col("open"), F.col("m") - F.col("any") + 1).otherwise(F.col("short")))
    spots = asked.where("long > 0").select("sid", "leader", "label", "open", "n", "d", "m", "short", F.posexplode(F.expr("slice(common, 1, int(least(long, m)))")).alias("at", "x"))
    spots = materialize(spots.select("sid", "leader", "label", "open", "n", "d", "m", F.col("at") < F.col("short"), F.col("x.gram").alias("gram")).toDF("sid", "leader", "label", "open", "n", "d", "m", "short", "gram"), "near-spots")
    other = spots.where("short").select("leader", "gram", *(F.col(c).alias(f"o_{c}") for c in ("sid", "label", "open", "n", "d", "m")))
    pairs = (
        spots.where("open")
        .join(other, ["leader", "gram"])
        .where("label <> o_label and (not o_open or (short and sid < o_sid))")
        .where(2 * F.least("m", "o_m") >= F.col("d") + F.col("o_d") - bound(F.col("n"), F.col("o_n")))
        .select(F.col("sid").alias("a"), F.col("o_sid").alias("b"))
        .distinct()
    )
    pairs = materialize(pairs, "near-pairs")
    sides = [near.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col("diff").alias(f"diff_{c}")) for c in "ab"]
    both = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    links = pairs.join(sides[0], "a").join(sides[1], "b").where((100 + percent) * both <= (100 - percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    links = materialize(links, "near-links")
    discard(spots, pairs)
    return links


def find_links(df: DataFrame, scanned: DataFrame, classes: DataFrame, twins: frozenset[int], params: JoinParams, key: str) -> DataFrame:
    """(a, b): enough links between classes to join every component, each link exact."""
    spark, percent = df.sparkSession, params.percent
    counts = spark.sparkContext.broadcast(order_of(scanned))  # 16 MB at most
    prefix = materialize(prefixes(df, params, counts, twins), "prefixes")
    shared, heads = shared_grams(prefix, percent)
    discard(prefix)
    votes = materialize(leader_votes(shared, heads, percent), "votes")
    best = materialize(followers(votes), "followers")
    following = gathered(votes, best, params)
    cells = in_cells(following, params)
    leaders = cells.select(F.col("cell").alias("block"), F.lit(0).alias("side"), F.col("leader").alias("sid")).distinct()
    stars = leaders.unionByName(cells.select(F.col("cell").alias("block"), F.lit(1).alias("side"), "sid"))
    rows = materialize(star_blocks(in_blocks(df, key, classes, stars, params, twins), counts, params), "stars")
    first = rows.where("diff is null").select("a", "b")

    joined = materialize(connected_components(first, "a", "b"), "components").select(F.col("node").alias("sid"), F.col("component").alias("label"))
    # followers in several cells: those near their leader are compared by what they differ in from it
    split = materialize(cells.groupBy("leader").agg(F.min("cell").alias("l"), F.max("cell").alias("h")).where("l <> h").select("leader"), "split")
    near = rows.where("diff is not null").select(F.col("a").alias("sid"), F.col("b").alias("leader"), "n", "base", "diff").join(small_side(split), "leader", "left_semi")
    near = near.join(joined, "sid", "left").join(joined.select(F.col("sid").alias("leader"), F.col("label").alias("lead")), "leader", "left")
    near = near.withColumn("label", F.coalesce("label", "sid")).withColumn("open", F.col("label") != F.coalesce("lead", "leader")).drop("lead")
    near = materialize(near, "near")
    second = near_links(near, percent)

    # everything else by pairs of cells; of a leader's cells the near ones are pure, and its only cell has been joined
    far = cells.join(small_side(split), "leader", "left_semi").join(near.select("sid"), "sid", "left_anti")
    apart = in_cells(near.select("sid", "leader"), params).withColumn("done", F.xxhash64("leader"))
    apart = apart.unionByName(in_cells(far.select("sid", "leader"), params).select("sid", "leader", F.xxhash64(F.lit(1), "cell").alias("cell"), F.lit(None).cast("long").alias("done")))
    apart = apart.unionByName(cells.join(small_side(split), "leader", "left_anti").withColumn("done", F.xxhash64("leader")))
    homes = shared.groupBy("sid").agg(F.first("n").alias("n")).join(joined, "sid", "left").join(apart, "sid", "left")
    homes = materialize(homes.select("sid", "n", F.coalesce("label", "sid").alias("label"), F.coalesce("cell", F.xxhash64("sid")).alias("cell"), F.when(F.col("cell").isNull(), F.xxhash64("sid")).otherwise(F.col("done")).alias("done")), "homes")
    at = shared.select("gram", "sid").join(homes, "sid")
    spots = at.groupBy("gram", "cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("done").alias("done"))
    spots = materialize(spots, "spots")
    open_grams = spots.groupBy("gram").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l <> h").select("gram")
    spots = spots.join(open_grams, "gram", "left_semi")
    other = spots.select("gram", *(F.col(c).alias(f"o_{c}") for c in ("cell", "lo", "hi", "n_lo", "n_hi", "done")))
    pairs = (
        spots.join(other, "gram")
        .where("cell <= o_cell")
        .where("done is null or o_done is null or done <> o_done")
        .where("lo <> hi or o_lo <> o_hi or lo <> o_lo")
        .where("cell <> o_cell or lo <> hi")
        .where(100 * F.col("n_hi") >= percent * F.col("o_n_lo"))
        .where(100 * F.col("o_n_hi") >= percent * F.col("n_lo"))
        .groupBy("cell", "o_cell")
        .agg(F.count("*").alias("c"), F.least(F.min("n_lo"), F.min("o_n_lo")).alias("n"))
        .where(F.col("c") >= _needed(F.col("n")))
    )
    pairs = materialize(pairs.select("cell", "o_cell", F.xxhash64("cell", "o_cell").alias("block")), "cell-pairs")
    members = pairs.select("block", F.explode(F.array_distinct(F.array("cell", "o_cell"))).alias("cell")).join(homes, "cell").select("block", F.lit(0).alias("side"), "sid").distinct()
    members = materialize(members, "members")
    third = materialize(join_blocks(in_blocks(df, key, classes, members, params, twins), counts, params), "links")
    discard(shared, heads, votes, best, following, cells, split, near, homes, pairs, members)
    return first.unionByName(second).unionByName(third)


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(sid, component_id): the least key of the classes that links join."""
    joined = materialize(connected_components(links, "a", "b"), "components")
    named = joined.withColumnRenamed("node", "sid").join(classes, "sid")
    ids = materialize(named.groupBy("component").agg(F.min("rep").alias("id")), "ids")
    linked = materialize(joined.join(ids, "component").select(F.col("node").alias("sid"), "id"), "linked")
    return classes.join(linked, "sid", "left").select("sid", F.coalesce("id", "rep").alias("component_id"))


def _classes(scanned: DataFrame) -> tuple[DataFrame, DataFrame, frozenset[int]]:
    """(key, n, sid) of each row, (sid, rep, copies) of each class, and the half ids that two classes have in common."""
    rows = scanned.where("sketch is null").select("key", F.col("n").cast("long").alias("n"), "sid", "check")
    grouped = lambda r: r.where("sid is not null").groupBy("sid").agg(F.min("key").alias("rep"), F.count("*").alias("copies"), F.min("check").alias("lo"), F.max("check").alias("hi"))
    classes = materialize(grouped(rows), "classes")
    twins = frozenset(r.sid for r in classes.where("lo <> hi").select("sid").collect())  # none below some billions of classes
    if twins:
        rows = rows.withColumn("sid", F.when(F.col("sid").isin(*twins), F.col("check")).otherwise(F.col("sid")))
        classes = materialize(grouped(rows), "classes")
    return rows.drop("check"), classes.drop("lo", "hi"), twins


def similarity_components(df: DataFrame, params: JoinParams = JoinParams(), key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id) of each row of (key, text): the least key reachable by links."""
    scanned = materialize(scan_sets(df, params, key), "sets-scan")
    rows, classes, twins = _classes(scanned)
    homes = _components(classes, find_links(df, scanned, classes, twins, params, key))
    return rows.join(homes, "sid", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))


def similarity_links(df: DataFrame, params: JoinParams = JoinParams(), key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, n_links) of each row: as ``similarity_components``, with the exact number of other
    rows that the row is similar to (rows with an equal set are, those with an empty one are not)."""
    scanned = materialize(scan_sets(df, params, key), "sets-scan")
    rows, classes, twins = _classes(scanned)
    found = count_links(df, scanned, classes, twins, params, key)
    homes = _components(classes, found.where("b is not null"))
    others = found.where("b is null").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("others"))
    totals = classes.join(others, "sid", "left").select("sid", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.join(homes.join(totals, "sid"), "sid", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
