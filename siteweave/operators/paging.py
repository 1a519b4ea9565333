"""Link scraping: mode routing, pagination with stop rules, fallback to the listing's own links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.selectors import document_links, static_links
from ..functions.urls import resolve_url
from ..session import written
from .merge import keep_first


def route(listings: DataFrame) -> DataFrame:
    """Adds ``mode``: static if the page's html is at hand, it has no pagination and both selectors are given; else browser."""
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    static = given("html") & ~F.coalesce("has_pagination", F.lit(False)) & given("parent_container_selector") & given("child_job_link_selector")
    return listings.withColumn("mode", F.when(static, "static").otherwise("browser"))


def pages_until_stop(pages: DataFrame, site: str = "site", page: str = "page_no", urls: str = "urls", more: str | None = None) -> DataFrame:
    """Rows of each site up to where paging stops, inclusive.

    Paging stops after a page if (from the second on) its set of urls is empty or equals the previous page's, or if its
    next control is not usable (``more`` is false). The stopping page's rows count; the first page never stops on emptiness.
    """
    order = Window.partitionBy(site).orderBy(page)
    as_set = F.array_sort(F.array_distinct(F.coalesce(urls, F.array().cast("array<string>"))))
    df = pages.withColumn("_set", as_set).withColumns({"_before": F.lag("_set").over(order), "_n": F.row_number().over(order)})
    stop = (F.col("_n") > 1) & ((F.size("_set") == 0) | (F.col("_set") == F.col("_before")))
    if more is not None:
        stop = stop | ~F.coalesce(F.col(more), F.lit(False))
    df = df.withColumn("_stops", F.coalesce(F.sum(stop.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return df.where("_stops = 0").drop("_set", "_before", "_n", "_stops")


def scrape(listings: DataFrame, page_store: DataFrame | None = None, key: str = "page_key") -> DataFrame:
    """(key, pos, title, url): links of each listing, static or over its stored pages, else the listing's own links.

    ``listings`` has careers_url, html, the merged listing columns; ``page_store`` (key, page_no, html, next_usable) holds
    what a browser session would see. The listing's links are used only where nothing was scraped.
    """
    routed = route(listings)
    args = lambda f, html: f(html, "careers_url", "parent_container_selector", "child_job_link_selector")
    some = F.coalesce(F.size("_static") > 0, F.lit(False))
    routed = routed.withColumn("_static", args(static_links, F.when(F.col("mode") == "static", F.col("html"))))
    if page_store is None:  # the listing's own page alone: nothing is joined, and it is parsed again only where the static way found nothing
        links = F.when(some, F.col("_static")).otherwise(args(document_links, F.when(~some, F.col("html"))))
        found = routed.select(key, "careers_url", "individual_job_links", F.lit(1).alias("page_no"), links.alias("links"))
        routed = found = written(found, "page-links")
        scraped = found.where("links is not null").select(key, "page_no", F.posexplode("links").alias("pos", "l"))
    else:
        routed = written(routed.drop("html"), "static-links")
        static = routed.where(some).select(key, F.lit(1).alias("page_no"), F.posexplode("_static").alias("pos", "l"))
        spec = routed.where(~some).select(key, "careers_url", "parent_container_selector", "child_job_link_selector")
        seen = page_store.select(key, "page_no", "html", "next_usable").join(spec, key).withColumn("links", args(document_links, F.col("html")))
        seen = pages_until_stop(seen.withColumn("urls", F.transform("links", lambda x: x["url"])), key, "page_no", "urls", "next_usable")
        scraped = static.unionByName(seen.where("links is not null").select(key, "page_no", F.posexplode("links").alias("pos", "l")))
    scraped = scraped.select(key, F.col("l.url").alias("url"), "page_no", "pos", F.col("l.title").alias("title"))
    scraped = written(keep_first(scraped, [key, "url"], ["page_no", "pos"]), "scraped")  # read twice below; pages are parsed once
    own = routed.join(scraped.select(key).distinct(), key, "left_anti").select(key, "careers_url", F.posexplode("individual_job_links").alias("pos", "l"))
    own = own.select(key, resolve_url(F.col("careers_url"), F.col("l.href")).alias("url"), F.lit(1).alias("page_no"), "pos", F.col("l.text").alias("title"))
    own = keep_first(own.where("url is not null"), [key, "url"], ["page_no", "pos"])
    order = Window.partitionBy(key).orderBy("page_no", "pos")
    return scraped.unionByName(own.select(*scraped.columns)).select(key, F.row_number().over(order).alias("pos"), F.coalesce("title", F.lit("")).alias("title"), "url")
