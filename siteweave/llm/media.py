"""Media columns in Ogg: page checksums, lacing values, logical streams and granule timestamps.

``encode`` stores payloads as unsigned 8-bit samples in one Ogg physical stream with two logical streams: the
samples, and a note that holds the payload's length before padding. ``decode`` verifies each page's checksum,
reassembles packets from lacing values (over page borders too), separates the logical streams by serial number,
checks page order, and derives times from granule positions. A damaged page raises ``OggError``.

Defined results of the column operators: a null text or payload is the empty one (padded to one unit); repeated
rows give equal values, since nothing but the payload goes into the stream; texts of any length are stored
whole; an empty table gives an empty result; extra columns are not carried.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow

UNIT = 64
PACKET_SAMPLES = 4096
SAMPLE_RATE = 8000
SAMPLES_SERIAL, NOTE_SERIAL = 0x50434D38, 0x4E4F5445
_MIRROR = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_HEAD = struct.Struct("<4sBBqIIIB")


class OggError(ValueError):
    pass


def checksum(data: bytes) -> int:
    """Ogg's CRC-32: polynomial 0x04c11db7, high bit first, zero start and end; zlib's is its mirror image."""
    mirrored = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{mirrored:032b}"[::-1], 2)


def _lacing(length: int) -> bytes:
    return b"\xff" * (length // 255) + bytes((length % 255,))


class _Stream:
    """Writes one logical stream's pages of at most 255 lacing values."""

    def __init__(self, serial: int):
        self.serial, self.number, self.lacing, self.body = serial, 0, bytearray(), []
        self.granule, self.continued = -1, False

    def page(self, flags: int) -> bytes:
        body = b"".join(self.body)
        head = _HEAD.pack(b"OggS", 0, flags | self.continued, self.granule, self.serial, self.number, 0, len(self.lacing))
        page = bytearray(head + self.lacing + body)
        page[22:26] = struct.pack("<I", checksum(bytes(page)))
        self.number, self.lacing, self.body, self.granule, self.continued = self.number + 1, bytearray(), [], -1, False
        return bytes(page)

    def put(self, packet: bytes, granule: int) -> Iterator[bytes]:
        """Adds a packet; yields the pages that it fills. A page without a packet's end has granule -1."""
        lacing, at = _lacing(len(packet)), 0
        while len(lacing) > 255 - len(self.lacing):
            room = 255 - len(self.lacing)
            self.lacing += lacing[:room]
            self.body.append(packet[at : at + 255 * room])
            at, lacing = at + 255 * room, lacing[room:]
            yield self.page(0)
            self.continued = True
        self.lacing += lacing
        self.body.append(packet[at:])
        self.granule = granule
        if len(self.lacing) == 255:
            yield self.page(0)


def encode(payload: bytes, note: bytes, packet_samples: int = PACKET_SAMPLES) -> bytes:
    """An Ogg physical stream of the payload (one sample a byte) and the note, their pages interleaved."""
    samples, notes, out = _Stream(SAMPLES_SERIAL), _Stream(NOTE_SERIAL), []
    for stream, head in ((samples, struct.pack("<4sBBI", b"PCM8", 1, 8, SAMPLE_RATE)), (notes, b"NOTE\x01")):
        stream.lacing, stream.body, stream.granule = bytearray(_lacing(len(head))), [head], 0
        out.append(stream.page(2))
    out.extend(notes.put(note, 1))
    out.append(notes.page(4))
    for at in range(0, len(payload), packet_samples):
        packet = payload[at : at + packet_samples]
        out.extend(samples.put(packet, at + len(packet)))
    out.append(samples.page(4))
    return b"".join(out)


@dataclass
class Logical:
    """A logical stream as read: its packets, the granule of each page that ends one, and page and time figures."""

    packets: list[bytes] = field(default_factory=list)
    pages: int = 0
    granule: int = 0
    ended: bool = False
    times: list[float] = field(default_factory=list)
    _open: list[bytes] = field(default_factory=list)


def decode(data: bytes, rate: int = SAMPLE_RATE) -> dict[int, Logical]:
    """The logical streams of a physical stream, by serial number."""
    streams: dict[int, Logical] = {}
    at, view = 0, memoryview(data)
    while at < len(data):
        if at + 27 > len(data):
            raise OggError("the stream ends within a page")
        magic, version, flags, granule, serial, number, crc, n = _HEAD.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        begin = at + 27 + n
        end = begin + sum(lacing)
        if magic != b"OggS" or version or end > len(data) or len(lacing) < n:
            raise OggError("no page where one must begin")
        if checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"page {number} of stream {serial:#x}: wrong checksum")
        if flags & 2:
            if serial in streams:
                raise OggError("a stream begins twice")
            streams[serial] = Logical()
        elif serial not in streams:
            raise OggError("a stream without a beginning")
        stream = streams[serial]
        if number != stream.pages or stream.ended or bool(flags & 1) != bool(stream._open):
            raise OggError(f"page {number} of stream {serial:#x} is out of order")
        stream.pages += 1
        size = 0
        for value in lacing:
            size += value
            if value < 255:
                stream._open.append(bytes(view[begin : begin + size]))
                stream.packets.append(b"".join(stream._open))
                stream._open, begin, size = [], begin + size, 0
        if size:
            stream._open.append(bytes(view[begin : begin + size]))
        if granule >= 0:
            if granule < stream.granule:
                raise OggError("granule positions run backwards")
            stream.granule = granule
            stream.times.append(granule / rate)
        stream.ended = bool(flags & 4)
        at = end
    if any(s._open or not s.ended for s in streams.values()):
        raise OggError("a stream without its end")
    return streams


def pad(raw: bytes, unit: int = UNIT) -> bytes:
    """Bytes 0 up to a positive multiple of ``unit``."""
    return raw + b"\0" * (unit if not raw else -len(raw) % unit)


def read_payload(media: bytes) -> tuple[bytes, int, Logical]:
    """(payload, its length before padding, the sample stream) of what ``encode`` has stored."""
    streams = decode(media)
    samples, notes = streams[SAMPLES_SERIAL], streams[NOTE_SERIAL]
    return b"".join(samples.packets[1:]), struct.unpack("<Q", notes.packets[1])[0], samples


def store_texts(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, media): each whole text in UTF-8, padded and stored as an Ogg stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                media = []
                for text in part.column(1):
                    raw = (text.as_py() or "").encode("utf-8")
                    media.append(encode(pad(raw), struct.pack("<Q", len(raw))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(media, pa.binary())], [key, "media"])

    return map_arrow(df.select(key, "text"), run, f"`{key}` {df.schema[key].dataType.simpleString()}, media binary")


def levels_of(payload: bytes) -> tuple[float, float]:
    """Mean and deviation of the sample levels, from whole-number sums, so that no machine's arithmetic shows in them."""
    counts = [int(c) for c in np.bincount(np.frombuffer(payload, np.uint8), minlength=256)]
    n, total, squares = len(payload), sum(i * c for i, c in enumerate(counts)), sum(i * i * c for i, c in enumerate(counts))
    return total / n, math.sqrt((squares * n - total * total) / (n * n))


def features(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Reads (key, media) back and describes each stream: lengths, digests, and level and timing features.

    feature: pages, packets, seconds from the last granule position, mean and deviation of the sample levels.
    """
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column(1):
                media = cell.as_py()
                payload, n_bytes, stream = read_payload(media)
                mean, spread = levels_of(payload)
                feature = f"pages={stream.pages} packets={len(stream.packets) - 1} seconds={stream.times[-1]:.3f} mean={mean:.3f} deviation={spread:.2f}"
                rows.append((n_bytes, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), sha256(media).hexdigest(), feature))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, *names])

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(key, "media"), run, f"`{key}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
