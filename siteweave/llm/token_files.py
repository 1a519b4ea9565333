"""Token-id files with a minimal perfect hash index.

Shards (``*.bin``) hold the ids of consecutive documents back to back, in key order over all shards: a header of
8 bytes, then 16-bit ids if the vocabulary allows it, else 32-bit. Index parts (``*.mph``) hold a minimal perfect
hash over a share of the keys and, per slot, a stored fingerprint, the shard, the offset and the length. A lookup
hashes the key to its part and slot, compares the fingerprint (so a key that is not there is not found), and
makes one range read. A repeated key is told apart by its occurrence number.

The hash is a cascade of bit tables: on each level, keys that alone have a position keep it, the others move on. Tables are
stored in blocks of 512 bits behind the number of bits set before them, so a single lookup reads a block a level (1.6 on
the average) and one slot, whatever the number of keys. Many lookups in one part read it once instead.

Files of a task attempt have names of their own: a shard, and beside it the manifest of its documents, written by the task
itself; only the row that a finished task returns for its shard refers to them, so a task run again leaves unused files at
worst. (Spark's own writer starts three ``chmod`` processes a file on a local file system.)

Defined results: null texts are documents of the end id alone; a null key is a key; repeated rows are stored each, also
where one key has more rows than a task should take; a request made twice is answered once; texts of any length are
stored whole; an empty table has no files; extra columns of any name are not carried; an id that the width of the files
can't hold is an error.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Output, RangeReader, filesystem, map_arrow, parts_for, work_path
from .tokens import vocabulary_size, word_encoder

MAGIC = b"TOKIDS"
KEYS_PER_PART = 500_000
_SLOT = np.dtype([("mark", "<u8"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])
_LEVELS = 24
BLOCK_BITS = 512
_BLOCK = np.dtype([("before", "<u8"), ("bits", "u1", (BLOCK_BITS // 8,))])
_REST = np.dtype([("h", "<u8"), ("mark", "<u8")])
HEAD_BYTES = 512
#: A part is read whole when more than one in so many of its keys are asked for.
WHOLE_FROM = 256


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Maps n distinct 64-bit hashes to 0..n-1. Hashes that never part (equal ones) get ``rest`` slots, found by mark."""

    def __init__(self, tables: list[tuple[int, int, np.ndarray]], rest: np.ndarray, size: int):
        """``tables``: bits, slots before the table, blocks of bits."""
        self.tables, self.rest, self.size = tables, rest, size

    @classmethod
    def build(cls, hashes: np.ndarray, marks: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The function and the slot of each input."""
        left, tables, used = np.arange(len(hashes)), [], 0
        slots = np.empty(len(hashes), np.int64)
        while len(left) and len(tables) < _LEVELS:
            size = max(64, 2 * len(left))
            spot = (_mixed(hashes[left], len(tables)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            ranks = np.cumsum(alone)
            blocks = np.zeros(-(-size // BLOCK_BITS), _BLOCK)
            bits = np.zeros(len(blocks) * BLOCK_BITS, bool)
            bits[:size] = alone
            blocks["bits"] = np.packbits(bits).reshape(-1, BLOCK_BITS // 8)
            blocks["before"][1:] = ranks[BLOCK_BITS - 1 : size - 1 : BLOCK_BITS][: len(blocks) - 1]
            tables.append((size, used, blocks))
            kept = alone[spot]
            slots[left[kept]] = used + ranks[spot[kept]] - 1
            used += int(ranks[-1])
            left = left[~kept]
        rest = np.zeros(len(left), _REST)
        rest["h"], rest["mark"] = hashes[left], marks[left]
        slots[left] = used + np.arange(len(rest))
        return cls(tables, rest, len(hashes)), slots

    def _in_rest(self, h: np.uint64, mark: np.uint64) -> int:
        same = np.flatnonzero((self.rest["h"] == h) & (self.rest["mark"] == mark))
        return self.size - len(self.rest) + int(same[0]) if len(same) else -1

    def find(self, hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """A slot for each hash, -1 where no level has one; the caller compares the stored mark."""
        slots, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, (size, used, blocks) in enumerate(self.tables):
            if not len(left):
                break
            spot = (_mixed(hashes[left], level) % np.uint64(size)).astype(np.int64)
            hit = np.zeros(len(left), bool)
            for cut in range(0, len(left), 8192):
                some = spot[cut : cut + 8192]
                block, at = blocks[some // BLOCK_BITS], some % BLOCK_BITS
                bits = np.unpackbits(block["bits"], axis=1)
                hit[cut : cut + 8192] = bits[np.arange(len(some)), at]
                rank = block["before"].astype(np.int64) + (bits * (np.arange(BLOCK_BITS) < at[:, None])).sum(axis=1)
                mine = left[cut : cut + 8192][hit[cut : cut + 8192]]
                slots[mine] = used + rank[hit[cut : cut + 8192]]
            left = left[~hit]
        for i in left if len(self.rest) else ():
            slots[i] = self._in_rest(hashes[i], marks[i])
        return slots

    def to_bytes(self) -> bytes:
        """Head of a fixed size, the hashes that never part, then the tables' blocks."""
        head = struct.pack("<IQQ", len(self.tables), len(self.rest), self.size) + b"".join(struct.pack("<QQ", size, used) for size, used, _ in self.tables)
        return b"".join([head.ljust(HEAD_BYTES, b"\0"), self.rest.tobytes(), *(blocks.tobytes() for _, _, blocks in self.tables)])

    @staticmethod
    def head(data: bytes) -> tuple[int, int, list[tuple[int, int, int]], int]:
        """(hashes that never part, slots, (bits, slots before, offset) of each table, where the slots begin)."""
        levels, n_rest, size = struct.unpack_from("<IQQ", data)
        at, tables = HEAD_BYTES + n_rest * _REST.itemsize, []
        for level in range(levels):
            bits, used = struct.unpack_from("<QQ", data, 20 + 16 * level)
            tables.append((bits, used, at))
            at += -(-bits // BLOCK_BITS) * _BLOCK.itemsize
        return n_rest, size, tables, at

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and where its bytes end."""
        n_rest, size, tables, end = cls.head(data)
        read = [(bits, used, np.frombuffer(data, _BLOCK, -(-bits // BLOCK_BITS), at)) for bits, used, at in tables]
        return cls(read, np.frombuffer(data, _REST, n_rest, HEAD_BYTES), size), end


class IndexPart:
    """A stored part, read by ranges: the head once, then for each lookup a block a level and a slot."""

    def __init__(self, read):
        """``read(offset, length)`` gives bytes of the part's file."""
        self.read = read
        n_rest, self.size, self.tables, self.slots = PerfectHash.head(read(0, HEAD_BYTES))
        self.rest = PerfectHash([], np.frombuffer(read(HEAD_BYTES, n_rest * _REST.itemsize) if n_rest else b"", _REST), self.size)

    def find(self, h: np.uint64, mark: np.uint64) -> np.void | None:
        """The key's slot (mark, shard, at, n), or None."""
        slot = -1
        for level, (bits, used, at) in enumerate(self.tables):
            spot = int(_mixed(np.array([h]), level)[0] % np.uint64(bits))
            data = self.read(at + spot // BLOCK_BITS * _BLOCK.itemsize, _BLOCK.itemsize)
            before, flags = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:], "big") >> (BLOCK_BITS - 1 - spot % BLOCK_BITS)
            if flags & 1:
                slot = used + before + flags.bit_count() - 1
                break
        else:
            slot = self.rest._in_rest(h, mark)
        if slot < 0:
            return None
        entry = np.frombuffer(self.read(self.slots + slot * _SLOT.itemsize, _SLOT.itemsize), _SLOT)[0]
        return entry if entry["mark"] == mark else None


@dataclass(frozen=True)
class TokenStore:
    """A written store: its folder, the manifest of documents (key, occurrence, shard, at, n_tokens), and small lists with an entry per file."""

    folder: str
    key: str
    manifest: DataFrame
    shards: list[str]
    bases: dict[str, int]
    parts: dict[int, str]
    n_parts: int
    width: int
    size: int  # bytes of ids


def _listing(shard: str) -> str:
    """The file with the manifest rows of a shard."""
    return shard.removesuffix(".bin") + ".parquet"


def _hashed(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Adds the key's hash, its fingerprint (an independent hash) and its index part."""
    cols = [F.col(key).isNull(), F.col(key), F.col("occurrence")]
    return df.withColumns({"h": F.xxhash64(*cols), "mark": F.xxhash64(F.lit("fingerprint"), *cols)}).withColumn("part", F.pmod(F.shiftright("h", 7), F.lit(parts)).cast("int"))


def write(df: DataFrame, tokenizer: str, end_id: int, vocabulary: int | None = None, key: str = "doc_id", special_as_text: bool = False) -> TokenStore:
    """Encodes (key, text) and writes shards in ascending key order, then the index. Texts are shuffled once.

    ``vocabulary`` is the number of ids, by default the tokenizer's; it decides the files' width."""
    spark = df.sparkSession
    folder = work_path(spark, "tokens")
    vocabulary = max(vocabulary or vocabulary_size(tokenizer), end_id + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    end = int(end_id).to_bytes(4, "little")
    names = [key, "occurrence", "shard", "at", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, at, rows, last, occurrence = word_encoder(tokenizer, special_as_text).encode, None, 0, 0, object(), 0
        for batch in batches:
            seconds, places, counts = [], [], []
            for k, text in zip(batch.column(0), batch.column(1), strict=True):
                k = k.as_py()
                if out is None:
                    out = Output(folder, f"shard-{TaskContext.get().partitionId():06d}", ".bin")
                    out.write(MAGIC + struct.pack("<H", width))
                    disk, path = filesystem(folder)
                    fields = [pa.field(names[0], batch.schema.field(0).type), *(pa.field(n, pa.string() if n == "shard" else pa.int64()) for n in names[1:])]
                    listing, first = pq.ParquetWriter(f"{path}/{_listing(out.name)}", pa.schema(fields), filesystem=disk), k
                occurrence = occurrence + 1 if k == last else 0
                last = k
                ids = np.frombuffer(encode(text.as_py() or "") + end, "<u4")
                if int(ids.max()) >> 8 * width:
                    raise ValueError(f"id {ids.max()} needs more than {width} bytes")
                out.write(ids.astype(f"<u{width}").tobytes())
                seconds.append(occurrence)
                places.append(at)
                counts.append(len(ids))
                at += len(ids)
            if counts:
                shard = pa.array([out.name] * batch.num_rows, pa.string())
                listing.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(seconds, pa.int64()), shard, pa.array(places, pa.int64()), pa.array(counts, pa.int64())], schema=listing.schema))
                rows += batch.num_rows
        if out is not None:
            out.close()
            listing.close()
            ends = pa.array([first, last], fields[0].type)
            yield pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([at], pa.int64()), pa.array([rows], pa.int64()), ends[:1], ends[1:]], ["shard", "tokens", "n", "first", "last"])

    kind = df.schema[key].dataType.simpleString()
    # the row's own number and the text's hash split a key of very many rows
    by = [F.col(key).asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = df.select(key, "text").repartitionByRange(*by).sortWithinPartitions(F.col(key).asc_nulls_first(), "text")
    written = map_arrow(ordered, run, f"shard string, tokens long, n long, first {kind}, last {kind}")
    shards, bases, total, rows, ends = [], {}, 0, 0, []
    for shard, tokens, n, first, last in sorted(map(tuple, written.collect()), key=lambda r: r[0]):  # a row per file
        shards.append(shard)
        bases[shard] = total
        total, rows = total + tokens, rows + n
        ends.append((first, last))
    schema = f"`{key}` {kind}, occurrence long, shard string, at long, n_tokens long"
    manifest = spark.read.schema(schema).parquet(*(f"{folder}/{_listing(s)}" for s in shards)) if shards else spark.createDataFrame([], schema)
    manifest = _numbered(manifest, key, shards, ends)
    n_parts = max(1, -(-rows // KEYS_PER_PART))
    parts = _write_index(_hashed(manifest, key, n_parts), folder, shards)
    return TokenStore(folder, key, manifest, shards, bases, parts, n_parts, width, total * width)


def _numbered(manifest: DataFrame, key: str, shards: list[str], ends: list[tuple]) -> DataFrame:
    """The manifest with occurrence numbers that run on where a key's rows do so from shard to shard; ``ends`` has each
    shard's first and last key."""
    across = [i for i in range(1, len(shards)) if ends[i][0] == ends[i - 1][1]]
    if not across:
        return manifest
    # a key that runs on is the first of its shard, so there is a row per file at most
    firsts = manifest.sparkSession.createDataFrame([(s, e[0]) for s, e in zip(shards, ends, strict=True)], f"_shard string, _first {manifest.schema[key].dataType.simpleString()}")
    own = (F.col("shard") == F.col("_shard")) & F.col(key).eqNullSafe(F.col("_first"))
    counts = {r.shard: r.n for r in manifest.join(F.broadcast(firsts), own).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    lasts = manifest.sparkSession.createDataFrame([(s, e[1]) for s, e in zip(shards, ends, strict=True)], f"_shard string, _first {manifest.schema[key].dataType.simpleString()}")
    tails = {r.shard: r.n for r in manifest.join(F.broadcast(lasts), own).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    offsets, run = [], 0
    for i in across:
        whole = i - 1 in across and ends[i - 1][0] == ends[i - 1][1]  # the shard before is of this key alone, and runs on too
        run = (run + counts[shards[i - 1]]) if whole else tails[shards[i - 1]]
        offsets.append((shards[i], ends[i][0], run))
    table = manifest.sparkSession.createDataFrame(offsets, f"_shard string, _first {manifest.schema[key].dataType.simpleString()}, _more long")
    more = F.coalesce("_more", F.lit(0)) + F.col("occurrence")
    return manifest.join(F.broadcast(table), own, "left").withColumn("occurrence", more).drop("_shard", "_first", "_more")


def _write_index(hashed: DataFrame, folder: str, shards: list[str]) -> dict[int, str]:
    """One perfect hash file per part; keys are dealt by hash, so a part's size is bounded."""
    number = {name: i for i, name in enumerate(shards)}

    def build(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        unsigned = lambda c: rows.column(c).to_numpy().view(np.uint64)
        function, slots = PerfectHash.build(unsigned("h"), unsigned("mark"))
        stored = np.empty(len(slots), _SLOT)
        stored["mark"][slots] = unsigned("mark")
        stored["shard"][slots] = [number[x] for x in rows.column("shard").to_pylist()]
        stored["at"][slots], stored["n"][slots] = rows.column("at").to_numpy(), rows.column("n_tokens").to_numpy()
        out = Output(folder, f"index-{part:06d}", ".mph")
        out.write(function.to_bytes() + stored.tobytes())
        out.close()
        return pa.table({"part": pa.array([part], pa.int32()), "name": pa.array([out.name])})

    made = hashed.select("part", "h", "mark", "shard", "at", "n_tokens").groupBy("part").applyInArrow(build, "part int, name string")
    return {r.part: r.name for r in made.collect()}  # a row per file


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """(key, occurrence, shard, at, n_tokens) of each wanted (key[, occurrence]) that the index has."""
    if "occurrence" not in keys.columns:
        keys = keys.withColumn("occurrence", F.lit(0).cast("long"))
    keys = keys.select(store.key, "occurrence").distinct()
    folder, parts, shards, key = store.folder, store.parts, store.shards, store.key
    names = [key, "occurrence", "shard", "at", "n_tokens"]

    def find(rows: pa.Table) -> pa.Table:
        name = parts.get(rows.column("part")[0].as_py())
        marks = rows.column("mark").to_numpy().view(np.uint64)
        found = np.zeros(len(marks), bool)
        entries = np.zeros(len(marks), _SLOT)
        if name is not None:
            disk, path = filesystem(folder)
            hashes = rows.column("h").to_numpy().view(np.uint64)
            with disk.open_input_file(f"{path}/{name}") as file:
                part = IndexPart(lambda at, n: file.read_at(n, at))
                if len(hashes) * WHOLE_FROM < part.size:
                    for i, (h, mark) in enumerate(zip(hashes, marks, strict=True)):
                        entry = part.find(h, mark)
                        if entry is not None:
                            found[i], entries[i] = True, entry
                else:
                    data = file.read_at(file.size(), 0)
                    function, at = PerfectHash.from_bytes(data)
                    slots = function.find(hashes, marks)
                    stored = np.frombuffer(data, _SLOT, function.size, at)
                    entries[slots >= 0] = stored[slots[slots >= 0]]
                    found = (slots >= 0) & (entries["mark"] == marks)
        kept, entries = rows.filter(pa.array(found)), entries[found]
        shard = pa.array([shards[i] for i in entries["shard"]], pa.string())
        return pa.table([kept.column(key), kept.column("occurrence"), shard, pa.array(entries["at"].astype(np.int64)), pa.array(entries["n"].astype(np.int64))], names)

    kind = keys.schema[key].dataType.simpleString()
    hashed = _hashed(keys.select(key, "occurrence"), key, store.n_parts)
    return hashed.groupBy("part").applyInArrow(find, f"`{key}` {kind}, occurrence long, shard string, at long, n_tokens long")


def read(store: TokenStore, located: DataFrame) -> DataFrame:
    """(key, occurrence, start, n_tokens, ids): range reads in file order; ids as little-endian unsigned 32-bit."""
    folder, width, bases, key = store.folder, store.width, store.bases, store.key
    names = [key, "occurrence", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader(folder)
        for whole in batches:
            for cut in range(0, whole.num_rows, 256):
                batch = whole.slice(cut, 256)
                starts, ids = [], []
                for shard, at, n in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                    raw = reader.read(shard, 8 + width * at, width * n)
                    ids.append(np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
                    starts.append(bases[shard] + at)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, pa.int64()), batch.column(4), pa.array(ids, pa.binary())], names)
        reader.close()

    kind = located.schema[key].dataType.simpleString()
    # as many tasks as the shards' bytes ask for, whatever the size of the rows that point to them
    ordered = located.repartitionByRange(parts_for(located.sparkSession, store.size), "shard", "at").sortWithinPartitions("shard", "at")
    return map_arrow(ordered, run, f"`{key}` {kind}, occurrence long, start long, n_tokens long, ids binary")
