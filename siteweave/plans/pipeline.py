"""The discovery and extraction pipeline: crawl, pick, analyze, scrape links, extract details, write results."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HeuristicConfig, PipelineConfig, RetryPolicy
from ..functions.html import minify_body
from ..functions.text import chunks, detail_prompt, listing_prompt, markdown
from ..functions.urls import normalize_url
from ..operators import extract, frontier, heuristics, merge, paging, telemetry
from ..session import ship, written
from ..sources import store


@dataclass(frozen=True)
class Result:
    crawled: DataFrame
    best: DataFrame
    report: DataFrame
    listings: DataFrame
    links: DataFrame
    details: DataFrame


class Pipeline:
    """Every stage takes and returns DataFrames; ``run`` chains them over a page store (url, html[, final_url, success])."""

    def __init__(self, spark: SparkSession, config: PipelineConfig = PipelineConfig(), rules: HeuristicConfig = HeuristicConfig(), listing_model: Callable = extract.OfflineListingModel, details_model: Callable = extract.OfflineDetailsModel):
        self.spark, self.config, self.rules = ship(spark), config, rules
        self.listing_model, self.details_model = listing_model, details_model
        self.offline = listing_model is extract.OfflineListingModel and details_model is extract.OfflineDetailsModel
        self.policy = RetryPolicy(config.llm_max_retries, config.llm_retry_base_ms)

    def seeds(self) -> DataFrame:
        return store.seeds(self.spark, self.config.seed_urls)

    def fetch(self, urls: DataFrame, fetcher: Callable, details: bool = False) -> DataFrame:
        """A page store of the urls by a fetcher, under the configured limits on calls; in batches of 50, or of 20 for detail pages."""
        return store.fetch(urls, fetcher, per_host=self.config.max_pages_per_host, calls=self.config.max_pages_global, batch_size=20 if details else 50, options=store.FetchOptions())

    def crawl(self, seeds: DataFrame, pages: DataFrame) -> DataFrame:
        return frontier.crawl(seeds, pages, self.config, score=lambda df: heuristics.score_pages(df, self.rules))

    def best(self, crawled: DataFrame) -> DataFrame:
        """The top page of each seed, if it is a listing (looked at after the choice, not before)."""
        top = heuristics.best_per_seed(crawled.withColumnRenamed("job_listing_score", "score"), "seed", ("depth", "pos"))
        return top.where("is_job_listing")

    def analyze(self, pages: DataFrame, key: str = "page_key") -> DataFrame:
        """Listing of each (key, url, html): from the cache by content, else from chunks, model and merge."""
        c = self.config
        pages = pages.select(key, "url", "html")
        hits = None
        if c.listing_cache_dir:
            hits, pages = store.split_by_cache(pages, store.read_cache(self.spark, c.listing_cache_dir))
            hits = hits.drop("content_sha256", "stored_at").withColumns({"cache_hit": F.lit(True), "chunks": F.lit(None).cast("long")})
        parts = chunks(pages.withColumn("body", minify_body("html")), "body", key, c.chunk_size, c.chunk_overlap, c.listing_max_chunks, c.lossy_tail)
        prompts = parts.withColumn("prompt", listing_prompt(F.col("chunk")))
        answers = extract.listing_responses(prompts, self.listing_model, self.policy, c.listing_max_total_tokens, c.listing_chunk_sleep_ms, key)
        answers = written(answers, "responses")  # model calls are made once
        merged = merge.merge_chunks(answers, key=key).drop("careers_url").join(answers.groupBy(key).agg(F.count("*").alias("chunks")), key)
        fresh = pages.drop("content_sha256").join(merged, key, "left").withColumns(
            {
                "is_job_listing": F.coalesce("is_job_listing", F.lit(False)),
                "score": F.coalesce("score", F.lit(0.0)),
                "has_pagination": F.coalesce("has_pagination", F.lit(False)),
                "parent_container_selector": F.coalesce("parent_container_selector", F.lit("")),
                "total_token_count": F.coalesce("total_token_count", F.lit(0).cast("long")),
                "chunks": F.coalesce("chunks", F.lit(0).cast("long")),
                "careers_url": F.col("url"),
                "cache_hit": F.lit(False),
            }
        )
        fresh = fresh.withColumn("individual_job_links", F.coalesce("individual_job_links", F.from_json(F.lit("[]"), fresh.schema["individual_job_links"].dataType.simpleString())))
        fresh = written(fresh, "listings")
        if c.listing_cache_dir:
            store.save_cache(fresh, c.listing_cache_dir)
        return fresh if hits is None else fresh.unionByName(hits.select(*fresh.columns))

    def scrape_links(self, listings: DataFrame, page_store: DataFrame | None = None, key: str = "page_key") -> DataFrame:
        return paging.scrape(listings, page_store, key)

    def details(self, links: DataFrame, pages: DataFrame, key: str = "page_key") -> DataFrame:
        """Details of the first links of each listing whose pages are in the store and fetched well."""
        first = merge.first_k(links, self.config.max_detail_urls, key, ["pos"]).select(key, F.col("url").alias("job_url"), normalize_url(F.col("url"), F.col("url")).alias("target"))
        first = written(first, "detail-links")
        wanted = frontier.stored_pages(pages).withColumnRenamed("url", "target").join(first.select("target").distinct(), "target")
        prompts = wanted.select("target", detail_prompt(markdown("html")).alias("prompt"))
        answers = written(extract.extract_details(prompts, self.details_model, self.policy, "target"), "details")  # one call a page
        return first.select(key, "job_url", "target").distinct().join(answers, "target").drop("target")

    def run(self, pages: DataFrame, seeds: DataFrame | None = None, output: str | None = None, run_id: str | None = None) -> Result:
        if not self.offline:
            self.config.check_models()
        seeds = self.seeds() if seeds is None else seeds
        log = telemetry.StageLog(self.spark, run_id or uuid.uuid4().hex)
        with log.stage("pipeline_start") as extra:
            extra["seeds"] = seeds.count()
        with log.stage("bfs_crawl"):
            crawled = written(self.crawl(seeds, pages), "crawled")
        best = written(self.best(crawled), "best")
        report = heuristics.report_lines(seeds, best)
        with log.stage("listing_llm") as extra:
            once = frontier.first_by(best.select(F.col("url").alias("page_key"), "url", "html"), ["page_key"], ["html"])
            listings = written(self.analyze(once), "analyzed")
            row = listings.agg(F.coalesce(F.sum("total_token_count"), F.lit(0)), F.count_if("cache_hit")).first()
            extra["tokens"], extra["cache_hit"] = row[0], row[1]
        with log.stage("job_links_scrape") as extra:
            links = written(self.scrape_links(listings), "links")
            extra["count"] = links.count()
        with log.stage("job_details_llm") as extra:
            details = written(self.details(links, pages), "answers")
            extra["job_rows"] = details.where("details is not null").count()
        with log.stage("pipeline_end"):
            if output:
                self.write(Result(crawled, best, report, listings, links, details), output)
        if output:
            routed = paging.route(listings)
            log.write(f"{output}/stage_events", telemetry.listing_events(listings, log.run_id).unionByName(telemetry.scrape_events(routed, links, log.run_id)))
        return Result(crawled, best, report, listings, links, details)

    def write(self, result: Result, output: str) -> None:
        store.append_lines(result.report, f"{output}/career_listings")
        store.append_json(result.listings.drop("html", "cache_hit", "chunks"), f"{output}/llm_outputs")
        store.write_links_csv(result.listings.select("page_key", "careers_url").join(result.links, "page_key", "left"), f"{output}/job_links")
        store.save_details(result.details, f"{output}/job_details")
