"""Sources and sinks: seeds, page stores, a fetch source, content-hash caches, blobs, and the engine's output files."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fingerprint, job_id
from ..functions.urls import host, normalize_url
from ..schemas import LISTING_SPEC, PAGE_STORE
from ..session import filesystem, ship, written


# Sources


def seeds(spark: SparkSession, text: str) -> DataFrame:
    """(seed): a comma-separated list, trimmed, without empty entries."""
    rows = spark.createDataFrame([(text,)], "t string")
    return rows.select(F.explode(F.split("t", ",")).alias("seed")).select(F.trim("seed").alias("seed")).where("seed <> ''")


def pages(spark: SparkSession, path: str) -> DataFrame:
    return ship(spark).read.parquet(path)


Fetcher = Callable[[list[str]], Iterator[dict]]


#: Hosts whose links count as social links.
SOCIAL_HOSTS = ("facebook.com", "twitter.com", "x.com", "linkedin.com", "instagram.com", "pinterest.com", "tiktok.com", "snapchat.com", "reddit.com")


def without_styles(html: Column) -> Column:
    """The page without its style elements."""
    return F.regexp_replace(html, r"(?is)<style\b[^>]*>.*?</style\s*>", "")


def without_social_links(html: Column) -> Column:
    """The page without anchors to social hosts and their subdomains; plain anchors, quoted or not."""
    hosts = "|".join(h.replace(".", r"\.") for h in SOCIAL_HOSTS)
    return F.regexp_replace(html, rf"""(?is)<a\b[^>]*\bhref\s*=\s*["']?\s*(?:https?:)?//(?:[a-z0-9-]+\.)*(?:{hosts})(?=[/:?#"'\s>])[^>]*>.*?</a\s*>""", "")


@dataclass(frozen=True)
class FetchOptions:
    """What a fetcher's browser is asked for, and what is taken out of its pages. The defaults are fixed values."""

    browser: str = "chromium"
    headless: bool = True
    viewport: tuple[int, int] = (1920, 1080)
    user_agent: str = "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 Chrome/116.0.0.0 Safari/537.36"
    wait_until: str = "domcontentloaded"
    frames: bool = True
    overlays: bool = False
    external_images: bool = False
    external_links: bool = True
    robots: bool = False
    cache: bool = False
    styles: bool = False
    social_links: bool = False


def as_fetched(pages: DataFrame, options: FetchOptions = FetchOptions()) -> DataFrame:
    """Pages as the fetch options leave them; by default neither styles nor social links stay. The other options are the fetcher's."""
    html = F.col("html") if options.styles else without_styles(F.col("html"))
    return pages.withColumn("html", html if options.social_links else without_social_links(html))


def fetch(
    urls: DataFrame, fetcher: Callable[..., Fetcher], url: str = "url", per_host: int = 5, calls: int | None = None, batch_size: int = 50, options: FetchOptions | None = None
) -> DataFrame:
    """The page-store rows that a fetcher returns. ``per_host`` bounds a host's parallel tasks, ``calls`` those of all
    hosts, neither ever the result.

    ``fetcher`` is made once per task, with the options if there are any, and called with batches of up to ``batch_size`` urls;
    a url it fails on is a row with success = false. With options the pages are left as these say.
    """
    names = ["url", "final_url", "html", "cleaned_html", "success"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = fetcher() if options is None else fetcher(options)
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for at in range(0, len(wanted), batch_size):
                rows = [{"final_url": r["url"], "cleaned_html": None, "success": True} | r for r in get(wanted[at : at + batch_size])]
                yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], pa.schema([(n, pa.bool_() if n == "success" else pa.string()) for n in names]))

    by = [host(F.col(url)), F.pmod(F.xxhash64(url), F.lit(per_host))]
    ship(urls.sparkSession)
    dealt = urls.select(F.col(url)).distinct()
    dealt = dealt.repartition(*by) if calls is None else dealt.repartition(calls, *by)  # a task calls once at a time
    got = dealt.mapInArrow(run, PAGE_STORE)
    return got if options is None else as_fetched(got, options)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(content_sha256, listing columns): the listing stored last for each hash (of several at one time, one by a fixed choice).
    A folder that is not there is an empty cache."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    schema = f"content_sha256 string, stored_at timestamp, {LISTING_SPEC}"
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where("content_sha256 is not null and is_job_listing is not null")
    others = [c for c in rows.columns if c != "content_sha256"]
    last = rows.groupBy("content_sha256").agg(F.max_by(F.struct(*others), F.struct("stored_at", F.to_json(F.struct(*others)))).alias("s"))
    return last.select("content_sha256", *(F.col(f"s.{c}").alias(c) for c in others))


def split_by_cache(pages: DataFrame, cache: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses). The body is hashed, not shuffled with the cache's rows when those are few."""
    keyed = pages.withColumn("content_sha256", fingerprint(F.col(html)))
    return keyed.join(cache, "content_sha256"), keyed.join(cache.select("content_sha256"), "content_sha256", "left_anti")


def content_dedupe(df: DataFrame, text: str, key: str) -> DataFrame:
    """(content_sha256, key, copies): the least key of each distinct text."""
    return df.where(F.col(text).isNotNull()).groupBy(fingerprint(F.col(text)).alias("content_sha256")).agg(F.min(key).alias(key), F.count("*").alias("copies"))


def html_blobs(pages: DataFrame, root: str = "blobs") -> DataFrame:
    """One row per distinct body: hash, a source url (the least), size in bytes and where it belongs."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(fingerprint(body).alias("content_sha256"), "url", F.octet_length(body).cast("long").alias("byte_length"))
    blobs = rows.groupBy("content_sha256").agg(F.min("url").alias("source_url"), F.first("byte_length").alias("byte_length"))
    return blobs.withColumn("storage_uri", F.concat(F.lit(f"{root}/"), F.substring("content_sha256", 1, 2), F.lit("/"), "content_sha256"))


def jobs(links: DataFrame, run_id: str, seed: str = "seed", listing_url: str = "listing_url", url: str = "url") -> DataFrame:
    """Rows of the jobs table without their extracted part."""
    target = normalize_url(F.col(url), F.col(listing_url))
    return links.select(job_id(F.col(seed), target).alias("id"), F.lit(run_id).alias("run_id"), F.col(listing_url).alias("listing_url"), target.alias("job_url"), F.col("title"))


def crawl_run(spark: SparkSession, run_id: str, seed_url: str, status: str, started, finished=None, meta: str = "{}") -> DataFrame:
    if status not in ("ok", "error", "partial"):
        raise ValueError("status is ok, error or partial")
    return spark.createDataFrame([(run_id, started, finished, seed_url, status, meta)], "id string, started_at timestamp, finished_at timestamp, seed_url string, status string, meta string")


# Sinks. Spark's commit protocol makes appends safe for concurrent tasks; no locks are needed.


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def append_lines(df: DataFrame, path: str, line: str = "line") -> None:
    df.select(line).write.mode("append").text(path)


def write_links_csv(links: DataFrame, path: str, base_url: str = "careers_url") -> DataFrame:
    """One CSV file per listing in ``job_links=<md5 of the base url>``, header Title,URL, links in order of ``pos`` where they
    have one. A row with a null url stands for a listing without links, whose file is its header alone. What the folder held
    before goes. Returns the written files, (job_links, file).

    Tasks write the files themselves: Spark's writer starts three processes a file on a local disk, and its commit moves every
    listing's folder in the driver. A file gets its name when it is whole, and a task that runs again replaces it by its like.
    """
    spark = links.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    pos = F.col("pos").cast("long") if "pos" in links.columns else F.lit(0).cast("long")
    own = F.md5(F.col(base_url).cast("binary")).alias("job_links")
    rows = links.where("url is not null").select(own, pos.alias("n"), F.to_csv(F.struct(F.coalesce("title", F.lit("")).alias("Title"), F.col("url").alias("URL")), {"escape": '"'}).alias("value"))
    heads = links.select(own).distinct().select("job_links", F.lit(None).cast("long").alias("n"), F.lit("Title,URL").alias("value"))
    lines = heads.unionByName(rows).repartition("job_links").sortWithinPartitions("job_links", F.col("n").asc_nulls_first(), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = filesystem(path)
        done: list[tuple[str, str]] = []
        key, out, name = None, None, ""

        def shut() -> None:
            if out is not None:
                out.close()
                disk.move(name, f"{top}/job_links={key}/part-00000.csv")
                done.append((key, f"{path}/job_links={key}/part-00000.csv"))

        for batch in batches:
            for k, value in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or k != key:
                    shut()
                    key, name = k, f"{top}/job_links={k}/_{uuid.uuid4().hex}"
                    disk.create_dir(f"{top}/job_links={k}", recursive=True)
                    out = disk.open_output_stream(name)
                out.write(value.encode() + b"\n")
            yield pa.RecordBatch.from_pylist([{"job_links": k, "file": f} for k, f in done], pa.schema([("job_links", pa.string()), ("file", pa.string())]))
            done = []
        shut()
        yield pa.RecordBatch.from_pylist([{"job_links": k, "file": f} for k, f in done], pa.schema([("job_links", pa.string()), ("file", pa.string())]))

    return written(lines.select("job_links", "value").mapInArrow(run, "job_links string, file string"), "csv-files")


def read_links_csv(files: DataFrame) -> DataFrame:
    """(job_links, heads, title, url) of written files by their names, without a listing of folders: the links of each file, or one
    row with nulls where it has none, and whether the file begins with the header (1) or not (0)."""
    schema = pa.schema([("job_links", pa.string()), ("heads", pa.int64()), ("title", pa.string()), ("url", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for key, file in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    disk, name = filesystem(file)
                    with disk.open_input_stream(name) as f:
                        lines = list(csv.reader(io.StringIO(f.read().decode(), newline="")))
                    heads = int(lines[:1] == [["Title", "URL"]])
                    rows += [{"job_links": key, "heads": heads, "title": t, "url": u} for t, u in lines[heads:] or [(None, None)]]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.repartition("job_links").mapInArrow(run, "job_links string, heads long, title string, url string")


def save_details(details: DataFrame, path: str) -> None:
    """Rows that have details; the others are dropped."""
    append_json(details.where("details is not null").select("job_url", "details.*"), path)


def save_cache(listings: DataFrame, path: str, html: str = "html") -> None:
    """Appends listings by content hash; reading takes the last of each, so a later listing replaces an earlier one."""
    names = [c.split()[0] for c in LISTING_SPEC.replace("struct<", " struct<").split(", ") if not c.startswith(" ")]
    names = [n for n in names if n in listings.columns]
    append_json(listings.select(fingerprint(F.col(html)).alias("content_sha256"), F.current_timestamp().alias("stored_at"), *names), path)
