"""Stage events: one JSON line per stage, null fields left out, extras (a JSON object) merged at top level with their types."""

from __future__ import annotations

import json
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STAGE_EVENTS


def event_lines(events: DataFrame) -> DataFrame:
    """(value): events of STAGE_EVENTS as JSON lines."""
    fields = ["run_id", "stage", "duration_ms", "seed", "url", "tokens"]
    base = F.to_json(F.struct(*(F.round(c, 2).alias(c) if c == "duration_ms" else c for c in fields)))
    merged = F.when(F.col("extra").isNull() | (F.col("extra") == "{}"), base).otherwise(F.concat(F.substring(base, 1, F.length(base) - 1), F.lit(","), F.substring("extra", 2, 1 << 30)))
    return events.select(merged.alias("value"))


class StageLog:
    """Collects the driver's stage timings (one row per stage of a run) and writes them as JSON lines."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.run_id, self.rows = spark, run_id, []

    @contextmanager
    def stage(self, name: str, seed: str | None = None, url: str | None = None):
        """Times a block; the event is recorded even if the block fails. The yielded dict takes tokens and extras."""
        extra: dict = {}
        begin = time.perf_counter()
        try:
            yield extra
        except Exception as e:
            extra["error"] = type(e).__name__
            raise
        finally:
            tokens = extra.pop("tokens", None)
            self.rows.append((self.run_id, name, round((time.perf_counter() - begin) * 1000, 2), seed, url, tokens, json.dumps(extra, default=str)))

    def events(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, STAGE_EVENTS)

    def write(self, path: str, more: DataFrame | None = None) -> None:
        """Appends the run's events, and with them ``more`` events of STAGE_EVENTS, such as one a listing."""
        events = self.events() if more is None else self.events().unionByName(more)
        event_lines(events).write.mode("append").text(path)


def listing_events(listings: DataFrame, run_id: str) -> DataFrame:
    """Events of each analyzed listing: post_crawl_analyze, and listing_llm with its tokens, chunks and whether the cache had it."""
    hit = F.col("cache_hit")
    called = F.when(hit, F.to_json(F.struct("cache_hit", F.col("total_token_count").alias("tokens")))).otherwise(F.to_json(F.struct("chunks", "cache_hit")))
    common = lambda stage, tokens, extra: listings.select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit(0.0).alias("duration_ms"), F.lit(None).cast("string").alias("seed"), F.col("careers_url").alias("url"), tokens.cast("long").alias("tokens"), extra.alias("extra")
    )
    return common("post_crawl_analyze", F.lit(None), F.lit('{"phase":"full"}')).unionByName(common("listing_llm", F.when(~hit, F.col("total_token_count")), called))


def scrape_events(listings: DataFrame, links: DataFrame, run_id: str, key: str = "page_key") -> DataFrame:
    """An event of each listing's link scrape: its mode and how many links came of it."""
    counts = links.groupBy(key).agg(F.count("*").alias("count"))
    mode = F.when(F.col("mode") == "static", "static_html").otherwise("browser").alias("mode")
    rows = listings.join(counts, key, "left").select("careers_url", F.to_json(F.struct(mode, F.coalesce("count", F.lit(0)).alias("count"))).alias("extra"))
    return rows.select(
        F.lit(run_id).alias("run_id"), F.lit("job_links_scrape").alias("stage"), F.lit(0.0).alias("duration_ms"), F.lit(None).cast("string").alias("seed"), F.col("careers_url").alias("url"), F.lit(None).cast("long").alias("tokens"), "extra"
    )
