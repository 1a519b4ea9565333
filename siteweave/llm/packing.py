"""Vector bin packing of token sequences with the dot-product heuristic.

A sequence holds at most ``max_tokens`` tokens, ``max_segments`` pieces and ``max_loss`` loss-bearing tokens, all at
once. One sequence is open at a time; of the waiting pieces that fit all three limits, the one goes in whose
demand vector has the largest dot product with the room left (both in shares of the limits). When none fits
whole, the piece of the largest dot product is cut to fill the sequence exactly. A sequence that a limit other than
tokens closes early, or that the input's end leaves open, is split into runs of power-of-two length, which need
no padding.

Each partition is packed on its own in one pass, with a bounded number of waiting pieces, so nothing is shuffled
and a lost task is simply run again. Defined results: a null or empty text is a document of its end token alone;
repeated rows are packed each; texts of any length are cut into pieces, every token in exactly one; of pieces with equal
dot products the one that came first goes in; an empty table gives no pieces; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .tokens import word_encoder


@dataclass(frozen=True)
class PackParams:
    max_tokens: int = 2048
    max_segments: int = 128
    max_loss: int = 2048
    waiting: int = 512


@dataclass
class Example:
    """Token ids as little-endian unsigned 32-bit bytes; ``loss[i]`` counts loss-bearing tokens before i (None: all bear)."""

    key: object
    ids: bytes
    loss: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.ids) // 4

    def loss_between(self, start: int, end: int) -> int:
        return end - start if self.loss is None else int(self.loss[end] - self.loss[start])

    def most_within(self, start: int, tokens: int, loss: int) -> int:
        """The largest length from ``start`` within both amounts."""
        end = min(len(self), start + tokens)
        if self.loss is None:
            return min(end - start, loss)
        return min(end, int(np.searchsorted(self.loss, self.loss[start] + loss, "right")) - 1) - start


Piece = tuple[Example, int, int]  # example, start, length


class Packer:
    """Feeds on examples and hands out closed sequences, each a list of pieces."""

    def __init__(self, params: PackParams = PackParams()):
        self.params = p = params
        self.limits = np.array([p.max_tokens, p.max_segments, p.max_loss], float)
        self.pool: list[tuple[Example, int]] = []
        self.demand = np.empty((0, 3))
        self._new: list[tuple[int, int, int]] = []
        self._open()

    def _open(self) -> None:
        self.pieces: list[Piece] = []
        self.room = self.limits.copy()

    def add(self, example: Example) -> Iterator[list[Piece]]:
        start, p = 0, self.params
        while len(example) - start >= p.max_tokens and example.loss_between(start, start + p.max_tokens) <= p.max_loss:
            yield [(example, start, p.max_tokens)]
            start += p.max_tokens
        if start < len(example):
            self.pool.append((example, start))
            self._new.append((len(example) - start, 1, example.loss_between(start, len(example))))
        if len(self.pool) >= p.waiting:
            yield from self._pack(p.waiting // 2)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._pack(0)
        yield from self._close()

    def _pack(self, down_to: int) -> Iterator[list[Piece]]:
        if self._new:
            self.demand = np.concatenate([self.demand, np.array(self._new, float)])
            self._new = []
        while len(self.pool) > down_to:
            score = self.demand @ (self.room / self.limits**2)
            fits = (self.demand <= self.room).all(axis=1)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                example, start = self.pool[i]
                self._place(example, start, len(example) - start)
                self.pool.pop(i)
                self.demand = np.delete(self.demand, i, axis=0)
            elif not self._cut(int(np.argmax(score))):
                yield from self._close()
                continue
            if self.room[0] < 1:
                yield from self._close()

    def _cut(self, i: int) -> bool:
        """Places as much of waiting piece i as there is room for; false if there is none."""
        if self.room[1] < 1:
            return False
        example, start = self.pool[i]
        length = example.most_within(start, int(self.room[0]), int(self.room[2]))
        if length < 1:
            return False
        self._place(example, start, length)
        start += length
        self.pool[i] = (example, start)
        self.demand[i] = (len(example) - start, 1, example.loss_between(start, len(example)))
        return True

    def _place(self, example: Example, start: int, length: int) -> None:
        self.pieces.append((example, start, length))
        self.room -= (length, 1, example.loss_between(start, start + length))

    def _close(self) -> Iterator[list[Piece]]:
        """The open sequence if it is full, else its power-of-two parts."""
        if self.room[0] < 1:
            yield self.pieces
        elif self.pieces:
            yield from power_parts(self.pieces)
        self._open()


def power_parts(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cuts a run of pieces into runs whose lengths are the powers of two that sum to its length, largest first."""
    total, queue = sum(p[2] for p in pieces), list(reversed(pieces))
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        part = []
        while size:
            example, start, length = queue.pop()
            if length > size:
                queue.append((example, start + size, length - size))
                length = size
            part.append((example, start, length))
            size -= length
        yield part


def _packed(examples: Callable[[pa.RecordBatch], Iterator[Example]], params: PackParams, key: str, kind: pa.DataType):
    names = [key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [kind, *[pa.int64()] * 5, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, rows, serial = Packer(params), [], TaskContext.get().partitionId() << 33

        def collect(sequences) -> None:
            nonlocal serial
            for sequence in sequences:
                offset = 0
                for example, start, length in sequence:
                    rows.append((example.key, start, length, len(example), serial, offset, example.ids[4 * start : 4 * (start + length)]))
                    offset += length
                serial += 1

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return out

        for incoming in batches:
            for example in examples(incoming):
                collect(packer.add(example))
                if len(rows) >= 1024:
                    yield batch()
        collect(packer.finish())
        if rows:
            yield batch()

    return run


def _schema(kind: str, key: str) -> str:
    return f"`{key}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, params: PackParams = PackParams(), key: str = "doc_id", special_as_text: bool = False) -> DataFrame:
    """Encodes (key, text), ends each document with ``end_id`` and packs all of it.

    Rows are pieces: (key, start, length, doc_tokens, sequence_id, offset, ids as little-endian unsigned 32-bit).
    """
    end = int(end_id).to_bytes(4, "little")

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        encode = word_encoder(tokenizer, special_as_text).encode
        for k, text in zip(batch.column(0), batch.column(1), strict=True):
            yield Example(k.as_py(), encode(text.as_py() or "") + end)

    df = df.select(key, "text")
    return map_arrow(df, _packed(examples, params, key, _arrow(df, key)), _schema(df.schema[key].dataType.simpleString(), key))


def pack_examples(df: DataFrame, params: PackParams = PackParams(), key: str = "doc_id") -> DataFrame:
    """Packs (key, ids array<int>, loss_mask array<boolean>), where any token may bear loss or not.

    A null or short mask counts as false beyond its end; a null ids column is an empty example, which has no pieces.
    """

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        for k, ids, mask in zip(*(batch.column(i) for i in range(3)), strict=True):
            ids = np.asarray(ids.as_py() or [], "<u4")
            loss = np.zeros(len(ids) + 1, np.int64)
            mask = np.asarray([bool(x) for x in (mask.as_py() or [])[: len(ids)]], np.int64)
            loss[1 : len(mask) + 1] = mask
            yield Example(k.as_py(), ids.tobytes(), np.cumsum(loss))

    df = df.select(key, "ids", "loss_mask")
    return map_arrow(df, _packed(examples, params, key, _arrow(df, key)), _schema(df.schema[key].dataType.simpleString(), key))


def pack_turns(turns: DataFrame, tokenizer: str, end_id: int, params: PackParams, bearing: tuple[str, ...] = ("assistant",), special_as_text: bool = False) -> DataFrame:
    """Packs each row of (conv_id, turn, role, text) as one example; the tokens of the ``bearing`` roles bear loss, the end token too.

    Rows are pieces: key (a struct of conv_id and turn), start, length, doc_tokens, sequence_id, offset, ids, and ``bears``,
    whether the piece's tokens bear loss. Turns are not gathered by conversation, so none can outgrow a task. A null text is the
    empty one; a null role bears no loss.
    """
    end = int(end_id).to_bytes(4, "little")

    def examples(batch: pa.RecordBatch) -> Iterator[Example]:
        encode = word_encoder(tokenizer, special_as_text).encode
        for key, role, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            ids, role = encode(text.as_py() or "") + end, role.as_py()
            loss = None if role in bearing else np.zeros(len(ids) // 4 + 1, np.int64)
            yield Example({**key.as_py(), "bears": loss is None}, ids, loss)

    key = F.struct("conv_id", "turn")
    rows = turns.select(key.alias("key"), "role", "text")
    kind = turns.select(F.struct("conv_id", "turn", F.lit(True).alias("bears")).alias("key"))
    packed = map_arrow(rows, _packed(examples, params, "key", _arrow(kind, "key")), _schema(kind.schema["key"].dataType.simpleString(), "key"))
    return packed.select(F.struct("key.conv_id", "key.turn").alias("key"), "start", "length", "doc_tokens", "sequence_id", "offset", "ids", F.col("key.bears").alias("bears"))


def _arrow(df: DataFrame, key: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[key].dataType)
