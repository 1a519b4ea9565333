"""WARC archives with a two-level capture index.

Writing: one archive per task (rolled over at a size), each record its own gzip member. Of records with equal
payloads the one of the least page id is a response, the others revisits that refer to it. Payloads are equal if their
lengths and SHA-256 digests are (records also bear the usual SHA-1 digest, which alone would not do). Whether a page is a
revisit is found from digests alone; bodies are not shuffled unless repeated digests are too many to broadcast.

Index: (reversed-host url, page id) keys are range-partitioned and sorted; each partition is an index shard of
compressed blocks of lines, closed by its sparse directory (first key, offset and length of each block). A lookup
bisects the shards' first keys (a list with an entry per file), then the shard's directory, range-reads one block,
bisects its lines, and range-reads the record.

Files of a task attempt have names of their own, and only committed manifest rows refer to them. Defined results:
a null html is an empty payload; a null url has an empty key and no target header; rows with one page id and
payload are each a record of the same type; texts of any length are one record; an empty table has no files;
a null page id is never what another record refers to, unless all equal payloads have null ids; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Output, RangeReader, map_arrow, materialize, parts_for, small_side, work_path
from .url_filters import host_of, path_of

CRLF = b"\r\n"


@dataclass(frozen=True)
class WarcParams:
    min_revisit_bytes: int = 0
    level: int = 3
    roll_bytes: int = 1 << 30
    block_lines: int = 2000
    date: str = "2026-01-01T00:00:00Z"


def capture_key(url: Column, page: Column) -> Column:
    """Reversed-host url, tab, sortable page id: ``com,example,www)/path?query<TAB>8000000000000001``."""
    rest = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    host = F.array_join(F.reverse(F.split(host_of(url), r"\.")), ",")
    plain = F.when(F.instr(rest, "://") > 0, F.concat(host, F.lit(")"), path_of(url), query)).otherwise(F.concat(F.lit(")"), rest))
    ident = F.coalesce(F.lpad(F.hex(page.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit("-"))
    return F.concat(F.regexp_replace(plain, r"[\x00-\x20\x7F]", "%20"), F.lit("\t"), ident)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> bytes:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value).encode("utf-8", "replace")


def record_id(page: int | None) -> bytes:
    return b"<urn:x-page:%s>" % (b"none" if page is None else b"%d" % page)


def page_of(identifier: bytes) -> int | None:
    value = identifier[len(b"<urn:x-page:") : -1]
    return None if value == b"none" else int(value)


def build_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: bytes) -> bytes:
    """A response record with its payload, or a revisit record with the headers of its response alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: " + record_id(page), b"WARC-Date: " + date]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _clean(url))
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + record_id(refers_to)]
    head += [b"WARC-Payload-Digest: sha1:" + digest_of(payload).encode(), b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return CRLF.join([*head, b"", block, b"", b""])


def parse_record(data: bytes) -> tuple[dict[bytes, bytes], bytes]:
    """(headers by lower-case name, content block) of one record."""
    head, _, rest = data.partition(CRLF + CRLF)
    first, *lines = head.split(CRLF)
    if not first.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(b":") for line in lines)}
    length = int(fields[b"content-length"])
    if rest[length:] != CRLF + CRLF:
        raise ValueError("the record's length is wrong")
    return fields, rest[:length]


def http_payload(block: bytes) -> tuple[int, bytes]:
    """(the Content-Length that the headers state, the bytes after the headers)."""
    head, _, body = block.partition(CRLF + CRLF)
    for line in head.split(CRLF)[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value), body
    return len(body), body


@dataclass(frozen=True)
class Archive:
    """Written archives and their index; ``shards`` has (first key, file, directory offset, directory length) per file."""

    folder: str
    manifest: DataFrame
    shards: list[tuple[str, str, int, int]]
    size: int  # bytes of records


def write(pages: DataFrame, params: WarcParams = WarcParams()) -> Archive:
    """Writes a record per row of (page_id, url, html), then the capture index."""
    folder = work_path(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit(""))
    base = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha2(html.cast("binary"), 256)).alias("sha"), F.octet_length(html).alias("size"))
    groups = base.where(F.col("size") >= params.min_revisit_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = materialize(groups.where("n > 1").drop("n"), "repeated")
    typed = base.join(small_side(repeated), ["sha", "size"], "left")
    typed = typed.withColumn("revisit", F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")))
    rows = typed.select("page_id", "url", "html", "first", "revisit", capture_key(F.col("url"), F.col("page_id")).alias("key"))
    date, level, roll = params.date.encode(), params.level, params.roll_bytes
    info = CRLF.join([b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Record-ID: <urn:x-archive:siteweave>", b"WARC-Date: " + date, b"Content-Type: application/warc-fields", b"Content-Length: 21", b"", b"software: siteweave\r\n", b"", b""])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            files, offsets, lengths = [], [], []
            for page, url, html, first, revisit in zip(*(batch.column(i) for i in range(5)), strict=True):
                if out is None or out.size >= roll:
                    if out is not None:
                        out.close()
                    out = Output(folder, f"pages-{TaskContext.get().partitionId():06d}", ".warc.gz")
                    out.write(zlib.compress(info, level, 31))
                record = build_record(page.as_py(), url.as_py(), html.as_py().encode("utf-8", "replace"), first.as_py(), revisit.as_py(), date)
                data = zlib.compress(record, level, 31)
                offsets.append(out.write(data))
                lengths.append(len(data))
                files.append(out.name)
            yield pa.RecordBatch.from_arrays([batch.column(5), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["key", "file", "at", "length"])
        if out is not None:
            out.close()

    manifest = materialize(map_arrow(rows, run, "key string, file string, at long, length long"), "captures")
    size = manifest.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return Archive(folder, manifest, write_index(manifest, folder, params), size)


def write_index(manifest: DataFrame, folder: str, params: WarcParams) -> list[tuple[str, str, int, int]]:
    per_block = params.block_lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, directory, lines, start = None, [], [], None

        def flush() -> None:
            data = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((lines[0], out.write(data), len(data)))
            lines.clear()

        for batch in batches:
            for key, file, at, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    out, start = Output(folder, f"index-{TaskContext.get().partitionId():06d}", ".cdx"), key
                lines.append(f"{key}\t{file}\t{at}\t{length}")
                if len(lines) >= per_block:
                    flush()
        if out is not None:
            if lines:
                flush()
            table = b"".join(struct.pack("<QII", at, n, len(k := first.encode())) + k for first, at, n in directory)
            at = out.write(table)
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([start]), pa.array([out.name]), pa.array([at], pa.int64()), pa.array([len(table)], pa.int64())], ["start", "file", "at", "length"])

    ordered = manifest.repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    shards = materialize(map_arrow(ordered, run, "start string, file string, at long, length long"), "shards")
    return sorted(((r.start, r.file, r.at, r.length) for r in shards.collect()), key=lambda s: (s[0], s[1]))  # a row per file


class IndexReader:
    """Finds the lines that begin with a request; keeps one directory and one block at hand."""

    def __init__(self, folder: str, shards: list[tuple[str, str, int, int]]):
        self.reader, self.shards = RangeReader(folder), shards
        self.starts = [s[0] for s in shards]
        self._directory: tuple[int, list[str], list[tuple[int, int]]] = (-1, [], [])
        self._block: tuple[tuple[int, int], list[str]] = ((-1, -1), [])

    def directory(self, shard: int) -> tuple[list[str], list[tuple[int, int]]]:
        if self._directory[0] != shard:
            _, file, at, length = self.shards[shard]
            data, firsts, places, pos = self.reader.read(file, at, length), [], [], 0
            while pos < length:
                offset, n, size = struct.unpack_from("<QII", data, pos)
                firsts.append(data[pos + 16 : pos + 16 + size].decode())
                places.append((offset, n))
                pos += 16 + size
            self._directory = (shard, firsts, places)
        return self._directory[1], self._directory[2]

    def lines(self, shard: int, block: int) -> list[str]:
        if self._block[0] != (shard, block):
            offset, n = self.directory(shard)[1][block]
            self._block = ((shard, block), zlib.decompress(self.reader.read(self.shards[shard][1], offset, n)).decode().split("\n"))
        return self._block[1]

    def find(self, request: str) -> Iterator[str]:
        """Lines from the block that may hold the request's first line on, over block and shard ends."""
        shard = max(0, bisect_left(self.starts, request) - 1)
        while shard < len(self.shards):
            firsts, _ = self.directory(shard)
            block = max(0, bisect_left(firsts, request) - 1)
            for block in range(block, len(firsts)):
                lines = self.lines(shard, block)
                for i in range(bisect_left(lines, request), len(lines)):
                    if not lines[i].startswith(request):
                        return
                    yield lines[i]
            shard += 1

    def close(self) -> None:
        self.reader.close()


def locate(archive: Archive, requests: DataFrame) -> DataFrame:
    """(request, key, file, at, length) for each distinct request: a capture key, or a reversed-host url and a tab for all its captures."""
    folder, shards = archive.folder, archive.shards
    names = ["request", "key", "file", "at", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = IndexReader(folder, shards)
        for batch in batches:
            rows = []
            for request in batch.column(0).to_pylist():
                for line in index.find(request):
                    url, page, file, at, length = line.split("\t")
                    rows.append((request, f"{url}\t{page}", file, int(at), int(length)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)
        index.close()

    ordered = requests.select("request").distinct().repartitionByRange("request").sortWithinPartitions("request")
    return map_arrow(ordered, run, "request string, key string, file string, at long, length long")


def read(archive: Archive, located: DataFrame) -> DataFrame:
    """The records at (file, at, length), range-read in file order; a response's payload is held against its digest.

    Columns: page_id, url, record_type, refers_to, payload_digest, payload_bytes (of the full payload), payload (null for a revisit).
    """
    folder = archive.folder
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader(folder)
        for whole in batches:
            for cut in range(0, whole.num_rows, 512):
                rows = []
                for file, at, length in zip(*(whole.slice(cut, 512).column(i).to_pylist() for i in range(3)), strict=True):
                    fields, block = parse_record(zlib.decompress(reader.read(file, at, length), 31))
                    kind, digest = fields[b"warc-type"].decode(), fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
                    size, payload = http_payload(block)
                    refers = page_of(fields[b"warc-refers-to"]) if kind == "revisit" else None
                    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
                        raise ValueError(f"{file} at {at}: the payload is damaged")
                    target = fields.get(b"warc-target-uri")
                    rows.append((page_of(fields[b"warc-record-id"]), target.decode() if target is not None else None, kind, refers, digest, size, payload if kind == "response" else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        reader.close()

    # as many tasks as the archives' bytes ask for, whatever the size of the rows that point to them
    tasks = parts_for(located.sparkSession, archive.size)
    ordered = located.select("file", "at", "length").repartitionByRange(tasks, "file", "at").sortWithinPartitions("file", "at")
    return map_arrow(ordered, run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")
