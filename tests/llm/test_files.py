import base64
import hashlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from siteweave.llm import token_files, warc
from siteweave.llm.tokens import word_encoder, word_tokenizer_path
from siteweave.session import shared_dir


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        h, mark = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 63, n).astype(np.uint64)
        if n > 10:
            h[5] = h[6] = h[7]  # equal hashes of different keys
        made, slots = token_files.PerfectHash.build(h, mark)
        assert sorted(slots) == list(range(n)) == list(range(made.size))
        data = made.to_bytes() + b"tail"
        back, end = token_files.PerfectHash.from_bytes(data)
        assert data[end:] == b"tail" and (back.find(h, mark) == slots).all()
        stored = np.zeros(n, token_files._SLOT)
        stored["mark"][slots], stored["n"][slots] = mark, np.arange(n)
        file, reads = made.to_bytes() + stored.tobytes(), []
        part = token_files.IndexPart(lambda at, size: reads.append(size) or file[at : at + size])  # noqa: B023
        reads.clear()
        for i in range(min(n, 2000)):
            assert part.find(h[i], mark[i])["n"] == i
        assert sum(reads) < 500 * max(1, min(n, 2000)) and part.find(np.uint64(12345), np.uint64(1)) is None


def test_one_key_over_many_shards(spark):
    rows = [(i, f"t{i}") for i in range(40)] + [(20, f"copy {i % 7}") for i in range(400)] + [(None, f"n{i}") for i in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), word_tokenizer_path(), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    manifest = store.manifest.collect()
    assert sorted(r.occurrence for r in manifest if r.doc_id == 20) == list(range(401)) and sorted(r.occurrence for r in manifest if r.doc_id is None) == list(range(100))
    assert len({r.shard for r in manifest if r.doc_id == 20}) > 1
    wanted = store.manifest.select("doc_id", "occurrence")
    found = token_files.read(store, token_files.locate(store, wanted.union(wanted))).collect()
    texts = {}
    for k, t in rows:
        texts.setdefault(k, []).append(t)
    got = {}
    for r in sorted(found, key=lambda r: r.start):
        got.setdefault(r.doc_id, []).append(bytes(r.ids))
    encode = word_encoder(word_tokenizer_path()).encode
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(encode(t) + b"\2\0\0\0" for t in v) for k, v in texts.items()}
    assert [r.start for r in sorted(found, key=lambda r: r.start)][-1] < store.size // store.width


def test_tasks_write_the_manifest_beside_their_shards(spark):
    rows = [(i, f"text {i}") for i in range(60)] + [(None, None), (None, "none")]
    root = Path(shared_dir(spark).removeprefix("file://")) / "siteweave"
    before = set(root.glob("*"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = token_files.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), word_tokenizer_path(), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # no table of Spark's writer, which starts a process three times a file
    assert [p.name for p in set(root.glob("*")) - before] == [store.folder.rsplit("/", 1)[1]]
    names = [p.name for p in (root / store.folder.rsplit("/", 1)[1]).iterdir()]
    listings = [s.removesuffix(".bin") + ".parquet" for s in store.shards]
    assert len(store.shards) > 1 and sorted(names) == sorted([*store.shards, *listings, *store.parts.values()])
    assert sorted(f.rsplit("/", 1)[1] for f in store.manifest.inputFiles()) == sorted(listings)
    # what an attempt left unfinished is not read
    (root / store.folder.rsplit("/", 1)[1] / "shard-000000-0123456789ab.parquet").write_bytes(b"PAR1")
    found = token_files.read(store, token_files.locate(store, store.manifest.select("doc_id", "occurrence"))).collect()
    encode = word_encoder(word_tokenizer_path()).encode
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in found) == sorted((str(k), encode(t or "") + b"\2\0\0\0") for k, t in rows)
    at = sorted((r.start, r.n_tokens) for r in found)
    assert [s for s, _ in at] == [sum(n for _, n in at[:i]) for i in range(len(at))] and sum(n for _, n in at) * store.width == store.size


def plain(rows):
    first, out = {}, {}
    for i, _, h in sorted(rows, key=lambda r: r[0]):
        payload = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        leader = first.setdefault(payload, i)
        out[i] = (len(payload), digest, "response" if leader == i else "revisit", None if leader == i else leader)
    return out


def test_warc(spark):
    bodies = [None, "", "same", "x" * 200_000, "é", "one", "two"]
    urls = ["http://a.b/x y", "http://a.b/x", "nourl", None, "https://Z.com:80/q?a=1#f"]
    rows = [(i, urls[i % 5], bodies[i % 7] if i % 3 else f"own {i}") for i in range(150)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, file string")
    archive = warc.write(df, warc.WarcParams(block_lines=4, roll_bytes=3000))
    wanted = df.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("request"))
    records = warc.read(archive, warc.locate(archive, wanted)).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records} == plain(rows)
    assert len(records) == len(rows)
    captures = spark.createDataFrame([("b,a)/x\t",), ("none\t",)], "request string")
    assert warc.locate(archive, captures).count() == sum(r[1] == "http://a.b/x" for r in rows)
    empty = warc.write(df.limit(0))
    assert warc.locate(empty, wanted).count() == 0


def test_small_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "http://a/", "ab"), (2, "http://a/", "ab"), (2, "http://a/", "ab"), (3, "http://a/", "abcdef"), (4, "http://a/", "abcdef")], "page_id long, url string, html string")
    archive = warc.write(df, warc.WarcParams(min_revisit_bytes=5))
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read(archive, warc.locate(archive, archive.manifest.select(F.col("key").alias("request")))).collect())
    assert got == [(1, "response", None), (2, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]
