"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A long unbroken string is random if a tiktoken vocabulary needs many tokens for it: fewer than ``max_ratio``
characters a token. Known digests and identifiers are left out first: digests are hex of a usual length, or hex or base 64
behind an algorithm's name, identifiers are UUIDs, numbers, and plain parts joined by marks. Digests and UUIDs may stand in
a path or behind a name; the rest of the string must then be plain parts. Plain is a number, a word (letters that are one
token or pass the test themselves, as marks would cost a token each), or a word of one token with up to four digits at
one end. Letters alone are no reason to leave a string out: words, compounds and camel case have few tokens, random
letters have many. The fixed patterns' spans always stay.

Spans are (kind, start, end) in code points, end exclusive. Defined results: a null or empty text has no spans;
repeated rows repeat; texts of any length are scanned whole; an empty table gives an empty result; extra columns
pass through ``redact`` (the text is replaced, other columns of any name stay).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import read_ranks
from .common import map_arrow

# Fixed values of the base patterns.
ASSIGN = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}

#: UUIDs, hex of the usual digest lengths, and digests behind an algorithm's name.
KNOWN = re.compile(
    r"(?i)(?<![a-z0-9])(?:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}|(?:(?:md5|sha-?[0-9]{1,3}|sha3-[0-9]{3}|blake2[bs])[-_/=]?)?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"
    r"|sha(?:256-[a-z0-9+/]{43}=?|384-[a-z0-9+/]{64}|512-[a-z0-9+/]{86}(?:==)?))(?![a-z0-9])"
)
PART = re.compile("[A-Za-z0-9]+")
NUMBERED = re.compile("([A-Za-z]+)[0-9]{1,4}|[0-9]{1,4}([A-Za-z]+)")


@dataclass(frozen=True)
class ScanParams:
    vocabulary: str = "byte_bpe_50k.tiktoken"
    min_length: int = 20
    max_ratio: float = 2.2


Span = tuple[int, int, int]  # start, index of the kind, end


class Scanner:
    def __init__(self, params: ScanParams = ScanParams()):
        import public_tokenizers
        import tiktoken

        self.params = params
        ranks = read_ranks(public_tokenizers.path(params.vocabulary))
        self._encode = tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._assign = re.compile(ASSIGN).finditer
        self._access = re.compile(ACCESS).finditer
        #: Runs long enough, taken whole: what a leftmost match of HEX with its length check gives.
        self._hex = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{SHORTEST['hex']},}}").finditer
        self._long = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{params.min_length},}}").finditer

    def base_spans(self, text: str) -> list[Span]:
        spans = [(m.start(), 0, m.end()) for m in self._assign(text) if len(m[2]) >= SHORTEST["assign"]]
        if "AKIA" in text:
            spans += [(m.start(), 1, m.end()) for m in self._access(text) if m.end() - m.start() >= SHORTEST["access"]]
        spans += [(m.start(), 2, m.end()) for m in self._hex(text)]
        return sorted(spans)

    def is_known(self, string: str) -> bool:
        """Digests and identifiers, which are no secrets however random they look."""
        rest = KNOWN.sub("-", string)
        parts = PART.findall(rest)
        return (len(parts) != 1 or rest != string or parts[0].isdigit()) and all(map(self.is_plain, parts))

    def is_plain(self, part: str) -> bool:
        if part.isdigit():
            return True
        if part.isalpha():
            return not self.is_costly(part) or len(self._encode(part)) == 1
        match = NUMBERED.fullmatch(part)
        return bool(match) and len(self._encode(match[1] or match[2])) == 1

    def is_costly(self, string: str) -> bool:
        return len(string) < self.params.max_ratio * len(self._encode(string))

    def random_spans(self, text: str) -> list[Span]:
        out = []
        for m in self._long(text):
            string = m[0]
            if self.is_costly(string) and not self.is_known(string):
                out.append((m.start(), 3, m.end()))
        return out

    def spans(self, text: str) -> list[Span]:
        return sorted(self.base_spans(text) + self.random_spans(text))


_scanners: dict[ScanParams, Scanner] = {}


def scanner(params: ScanParams) -> Scanner:
    """One scanner per Python worker and parameters."""
    if params not in _scanners:
        _scanners[params] = Scanner(params)
    return _scanners[params]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(df: DataFrame, params: ScanParams = ScanParams(), key: str = "doc_id") -> DataFrame:
    """(key, spans array<struct<kind, start, end>>) for each row. One pass, no shuffle."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(params).spans
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find(text.as_py() or "")] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], [key, "spans"])

    return map_arrow(df.select(key, "text"), run, f"`{key}` {df.schema[key].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>")


def span_digests(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and all spans as a string, from ``scan``'s rows."""
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] != "random"), label), ",")
    return scanned.select(
        key, count("assign"), count("access"), count("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("spans", label), ",").alias("spans")
    )


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """Covered stretches, overlaps united."""
    out: list[tuple[int, int]] = []
    for start, _, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def redact(df: DataFrame, params: ScanParams = ScanParams(), mark: str = "[SECRET]") -> DataFrame:
    """The rows with each secret in ``text`` replaced by ``mark``; a null text stays null."""
    names, at = df.columns, df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(params).spans
        for batch in batches:
            texts = []
            for cell in batch.column(at):
                text = cell.as_py()
                spans = find(text) if text else []
                if spans:
                    pieces, done = [], 0
                    for start, end in merged(spans):
                        pieces += [text[done:start], mark]
                        done = end
                    text = "".join(pieces) + text[done:]
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(df, run, df.schema)
