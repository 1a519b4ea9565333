import hashlib
import math
import random
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siteweave.llm import media


def bitwise(data: bytes) -> int:
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


@given(st.binary(max_size=300))
def test_checksum_is_the_plain_one(data):
    assert media.checksum(data) == bitwise(data)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5000), st.sampled_from([1, 64, 254, 255, 256, 510, 4096, 65025, 70000]))
def test_round_trip(length, packet):
    payload = media.pad(bytes(i * 7 % 256 for i in range(length * 37)))
    stored = media.encode(payload, struct.pack("<Q", length * 37), packet) if packet > 60 or length < 50 else media.encode(payload, struct.pack("<Q", length * 37))
    back, n, stream = media.read_payload(stored)
    assert back == payload and n == length * 37 and stream.granule == len(payload)


def test_damage_is_found():
    stored = bytearray(media.encode(b"x" * 9000, struct.pack("<Q", 9000)))
    stored[200] ^= 1
    with pytest.raises(media.OggError):
        media.decode(bytes(stored))
    with pytest.raises(media.OggError):
        media.decode(media.encode(b"x" * 64, b"12345678")[:-5])


def test_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "é" * 100, "z"), (3, "é" * 100, "z"), (4, "a" * 300_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    out = sorted(media.features(media.store_texts(df)).collect())
    assert [(r.doc_id, r.n_bytes, r.payload_bytes) for r in out] == [(1, 0, 64), (2, 0, 64), (3, 200, 256), (3, 200, 256), (4, 300_000, 300_032)]
    assert out[0][1:] == out[1][1:] and out[2] == out[3]
    assert out[2].tail_crc32 == zlib.crc32(("é" * 100).encode()[-8:] + b"\0" * 56)
    assert media.features(media.store_texts(df.limit(0))).count() == 0


def brute_stream(payload: bytes, n: int) -> tuple[bytes, int, int]:
    """The stored form, written page by page with a bitwise checksum: (bytes, pages and packets of the samples)."""

    def page(serial, number, flags, granule, packets, ends):
        lacing = b"".join(b"\xff" * (len(p) // 255) + (bytes([len(p) % 255]) if whole else b"") for p, whole in zip(packets, ends, strict=True))
        head = struct.pack("<4sBBqIIIB", b"OggS", 0, flags, granule, serial, number, 0, len(lacing)) + lacing + b"".join(packets)
        return head[:22] + struct.pack("<I", bitwise(head)) + head[26:]

    one, two = media.SAMPLES_SERIAL, media.NOTE_SERIAL
    out = [page(one, 0, 2, 0, [struct.pack("<4sBBI", b"PCM8", 1, 8, 8000)], [True]), page(two, 0, 2, 0, [b"NOTE\x01"], [True]), page(two, 1, 4, 1, [struct.pack("<Q", n)], [True])]
    # lacing values of all packets in a row, 255 a page; a page ends early only at the end
    cells = []
    packets = [payload[i : i + 4096] for i in range(0, len(payload), 4096)]
    for k, p in enumerate(packets):
        sizes = [255] * (len(p) // 255) + [len(p) % 255]
        at = 0
        for j, size in enumerate(sizes):
            cells.append((k, p[at : at + size], size, j == len(sizes) - 1))
            at += size
    pages = [cells[i : i + 255] for i in range(0, len(cells), 255)]
    if not cells or len(cells) % 255 == 0:
        pages.append([])
    for i, part in enumerate(pages):
        done = [k for k, _, _, last in part if last]
        granule = min(len(payload), 4096 * (done[-1] + 1)) if done else -1
        continued = i > 0 and not pages[i - 1][-1][3]
        lacing = bytes(size for _, _, size, _ in part)
        head = struct.pack("<4sBBqIIIB", b"OggS", 0, (4 if i == len(pages) - 1 else 0) | continued, granule, one, i + 1, 0, len(lacing)) + lacing + b"".join(x for _, x, _, _ in part)
        out.append(head[:22] + struct.pack("<I", bitwise(head)) + head[26:])
    return b"".join(out), len(pages) + 1, len(packets)


def test_features_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "é", "a" * 63, "b" * 64, "c" * 4096, "".join(chr(rng.randint(32, 900)) for _ in range(6000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in media.features(media.store_texts(df)).collect():
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\0" * (64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
        stored, pages, packets = brute_stream(payload, len(raw))
        mean = sum(payload) / len(payload)
        spread = math.sqrt(sum((x - mean) ** 2 for x in payload) / len(payload))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()), r.doc_id
        assert r.feature == f"pages={pages} packets={packets} seconds={len(payload) / 8000:.3f} mean={mean:.3f} deviation={spread:.2f}"


def test_levels_of_long_streams_are_exact():
    payload = bytes(range(256)) * 20_000 + b"\xff" * 64
    mean, spread = media.levels_of(payload)
    exact = sum(payload) / len(payload)
    assert mean == exact and abs(spread - math.sqrt(sum(20_000 * (i - exact) ** 2 for i in range(256)) / len(payload) + 64 * (255 - exact) ** 2 / len(payload))) < 1e-9
