"""Byte-level BPE by prefix dynamic programming.

For each byte prefix of a piece the table keeps the one token that ends the prefix's encoding. Token t may end
prefix i if it is the prefix's suffix, encodes to itself, and the pair (last token of the prefix before t, t)
encodes to itself; exactly one token qualifies, because a sequence is an encoding just if all its neighbours are.
The table answers every prefix, so bytes append exactly. An entry depends on the bytes and entries of the longest
token's length before it, so an edit recomputes from its place on until that many entries are the old ones; the rest of
the old table is kept. Decoding joins the tokens' bytes.

Defined results of ``encode_documents``: a null text is the empty text with no ids; repeated rows repeat; texts
of any length are encoded whole; an empty table gives an empty result; extra columns of any name are not carried.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow

CACHE_ENTRIES = 400_000
PAIR_ENTRIES = 2_000_000
_loaded: dict[tuple[str, str], "PieceEncoder"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 token and rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens that encode to themselves, the two halves of their last merge, and memoized answers on pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        whole: dict[bytes, int] = {}
        self._halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        for token, rank in ranks.items():
            parts = self._merged(token, 2)
            if len(parts) == 1 or (len(parts) == 2 and all(x in ranks for x in parts)):
                whole[token] = rank
                if len(parts) == 2:
                    self._halves[rank] = (ranks[parts[0]], ranks[parts[1]])
        automaton = ahocorasick.Automaton()
        for token, rank in whole.items():
            automaton.add_word(token.decode("latin-1"), rank << 10 | len(token))
        automaton.make_automaton()
        #: (last position, rank and length) of every token in a string; at each position the longest first.
        self.suffixes = automaton.iter

    def _merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """Plain merging of a short string, the leftmost pair of least rank each time, down to ``least`` parts."""
        ranks, none = self.ranks, 1 << 60
        parts = [data[i : i + 1] for i in range(len(data))]
        scores = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while len(parts) > least:
            rank = min(scores)
            if rank == none:
                break
            i = scores.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """True if no merge ever joins the two: undo their merges, latest first, and look at what then touches.

        Of merges of one rank the leftmost goes first, so a join across the border wins a tie against a merge
        inside the right token and loses one against the left.
        """
        ranks, of, halves, none = self.ranks, self.bytes_of, self._halves, 1 << 60
        x, y, until, known = left, right, none, True
        while True:
            if ranks.get(of[x] + of[y], none) < until:
                known = False
                break
            split_x, split_y = halves.get(x), halves.get(y)
            if split_x and (not split_y or x > y):
                until, x = x, split_x[1]
            elif split_y:
                until, y = y + 1, split_y[0]
            else:
                break
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        self.pairs[left << 32 | right] = known
        return known


class PrefixTable:
    """last[i]: the token that ends the encoding of the first i bytes (last[0] is -1)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extends the table; nothing before is touched."""
        vocabulary, last = self.vocabulary, self.last
        pairs, may_follow = vocabulary.pairs.get, vocabulary.may_follow
        done = len(self.data)
        self.data = self.data + more
        first = max(0, done - vocabulary.longest)
        for at, found in vocabulary.suffixes(self.data[first:].decode("latin-1")):
            at += first
            if at < done:  # known, or a longer suffix has fitted
                continue
            token = found >> 10
            start = at + 1 - (found & 1023)
            if start:
                before = last[start]
                fits = pairs(before << 32 | token)
                if not (may_follow(before, token) if fits is None else fits):
                    continue
            if at > done:
                break
            last.append(token)
            done += 1
        if done < len(self.data):
            raise ValueError("a byte has no token")

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces data[start:end] and returns how many entries were computed: those from ``start`` on until the tables meet."""
        old, tail, reach = self.last, self.data[end:], self.vocabulary.longest
        self.data, self.last = self.data[:start], old[: start + 1]
        self.append(new)
        shift, at, step = len(self.data) - end, 0, reach
        while at < len(tail):
            self.append(tail[at : at + step])
            at, step = at + step, 2 * step
            n = len(self.data)
            if reach <= at < len(tail) and self.last[n + 1 - reach :] == old[n + 1 - reach - shift : n + 1 - shift]:
                self.data, self.last = self.data + tail[at:], self.last + old[n + 1 - shift :]
                return n - start
        return len(self.data) - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, read backwards along the table."""
        at, out = len(self.data) if end is None else end, []
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[self.last[at]])
        return out[::-1]


class _Cache(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[key] = self.make(key)
        return value


class PieceEncoder:
    """Encodes texts piece by piece (matches of ``pattern``); a piece that is one token of the file is that token."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = Vocabulary(read_ranks(path))
        self.find = regex.compile(pattern).findall
        self.names = {rank: str(rank) for rank in self.vocabulary.bytes_of}
        self._same = {rank: rank for rank in self.vocabulary.bytes_of}
        self._pieces = _Cache(self._piece)
        self._chunks = _Cache(self._chunk)
        #: White space that a cut before a blank would split.
        self._uneven = re.compile(r"\s (?!\S)").search

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "replace")
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            return (self._same[whole],)
        return tuple(self._same[i] for i in PrefixTable(self.vocabulary, data).ids())

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a blank and what follows it up to the next one."""
        return tuple(chain.from_iterable(map(self._pieces.__getitem__, self.find(" " + chunk))))

    def encode(self, text: str) -> list[int]:
        """A match crosses a single blank only from its left, so a text with even blanks is cut before each blank."""
        if self._uneven(text):
            return list(chain.from_iterable(map(self._pieces.__getitem__, self.find(text))))
        first, *rest = text.split(" ")
        ids = list(chain.from_iterable(map(self._pieces.__getitem__, self.find(first))))
        ids.extend(chain.from_iterable(map(self._chunks.__getitem__, rest)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def piece_encoder(path: str, pattern: str) -> PieceEncoder:
    """One encoder per Python worker, file and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = PieceEncoder(path, pattern)
    return _loaded[path, pattern]


def encode_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the ids of each whole text and the bytes they decode to. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [coder.encode(text or "") for text in part.column(1).to_pylist()]
                decoded = [coder.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], [key, "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(key, "text"), run, f"`{key}` {kind}, ids array<int>, decoded binary")


def encoding_digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of the same encoding, digested where it is made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_encoder(path, pattern)
        for batch in batches:
            counts, id_hashes, byte_hashes = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py() or "")
                counts.append(len(ids))
                id_hashes.append(sha256(",".join(map(coder.names.__getitem__, ids)).encode()).hexdigest())
                byte_hashes.append(sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(byte_hashes, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(key, "text"), run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
