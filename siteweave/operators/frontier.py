"""Level-synchronous breadth-first discovery of many seeds at once, as a loop of joins.

Per level: frontier joins the page store, links are resolved and filtered, capped, and those seen before leave by an
anti join. Each level is a written table, so a lost executor repeats a level at most and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..session import written


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Distinct by keys, the first row in order stays (a minimum, combined before the shuffle)."""
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*(F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("_first")) if others else df.distinct()
    return best.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in others)) if others else best


def expand(seeds: DataFrame, edges: DataFrame, max_depth: int, level_cap: int | None = None) -> DataFrame:
    """(seed, url, source_url, depth, pos): every url reached within ``max_depth`` of its seed, at its first depth; ``pos``
    orders the urls of a seed's level.

    ``seeds`` has (seed, url); ``edges`` (source_url, url, pos) are admitted, resolved links. A level takes at most
    ``level_cap`` + 1 links of a seed, counted in crawl order before repeats are removed.
    """
    level = written(seeds.select("seed", "url", F.lit(None).cast("string").alias("source_url"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("pos")), "level")
    levels, visited = [level], level.select("seed", "url")
    for depth in range(1, max_depth + 1):
        step = level.select("seed", F.col("url").alias("source_url"), F.col("pos").alias("parent_pos")).join(edges, "source_url")
        step = step.join(visited, ["seed", "url"], "left_anti")
        if level_cap is not None:
            order = Window.partitionBy("seed").orderBy("parent_pos", "source_url", "pos", "url")
            step = step.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= level_cap + 1).drop("_n")
        step = first_by(step, ["seed", "url"], ["parent_pos", "source_url", "pos"])
        # places in crawl order by range partitions, so that no seed's level is sorted in one task; they have gaps
        order = ["seed", "parent_pos", "source_url", "pos", "url"]
        numbered = step.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
        level = written(numbered.select("seed", "url", "source_url", F.lit(depth).alias("depth"), "pos"), "level")
        if level.isEmpty():
            break
        levels.append(level)
        visited = visited.unionByName(level.select("seed", "url"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def page_edges(pages: DataFrame, config: PipelineConfig = PipelineConfig(), follow_all: bool = False) -> DataFrame:
    """(source_url, url, pos, kind) of admitted links of a page store with (url, html)."""
    from ..functions.html import page_links
    from ..functions.urls import admissible, host, is_job_link, resolve_url

    found = page_links(pages, "url").where(F.trim("href") != "")
    found = found.where(admissible(F.col("href"), F.col("target"), F.col("source_url")))
    if not follow_all:
        found = found.where(is_job_link(F.col("href"), F.col("text")))
    found = found.withColumn("kind", F.when(host(F.col("target")) == F.lower(host(F.col("source_url"))), "internal").otherwise("external"))
    if not config.include_external:
        found = found.where("kind = 'internal'")
    url = F.col("target") if config.dedupe_key == "normalized" else resolve_url(F.col("source_url"), F.col("href"))
    pos = F.col("pos").cast("long") + F.when(F.col("kind") == "external", 1 << 32).otherwise(0)  # internal links come first
    return found.select("source_url", url.alias("url"), pos.alias("pos"), "kind")


def stored_pages(store: DataFrame) -> DataFrame:
    """(url, page_url, html[, cleaned_html]) of the pages fetched well, one for each normalized url.

    Of pages with one normalized url the one stored under just that address stays, else the least address; of several
    under one address the least by final address and body hash. Bodies go through the shuffle only where addresses repeat.
    """
    from ..functions.urls import normalize_url

    ok = store.where(F.coalesce("success", F.lit(True))) if "success" in store.columns else store
    where = F.coalesce("final_url", "url") if "final_url" in store.columns else F.col("url")
    named = ok.withColumns({"_own": F.col("url"), "_page": where, "_url": normalize_url(F.col("url"), F.col("url"))}).where("_url is not null")
    rank = F.struct((F.col("_own") != F.col("_url")).alias("other"), "_own", "_page", F.xxhash64("html").alias("body"))
    kept = written(named.select("_url", rank.alias("rank")).groupBy("_url").agg(F.min("rank").alias("best"), F.count("*").alias("n")), "page-store")
    out = named.select("_url", rank.alias("rank"), F.col("_page").alias("page_url"), "html", *(["cleaned_html"] if "cleaned_html" in ok.columns else []))
    others = [c for c in out.columns if c not in ("_url", "rank")]
    # stored once: nothing to compare; stored again: the best row, one of those that are alike
    twice = kept.where("n > 1").select("_url", "best")
    again = out.join(twice, "_url").where("rank = best").groupBy("_url").agg(F.min(F.struct(*others)).alias("row")).select("_url", "row.*")
    single = out.join(twice.select("_url"), "_url", "left_anti").select("_url", *others)
    return single.unionByName(again).withColumnRenamed("_url", "url")


def crawl(seeds: DataFrame, store: DataFrame, config: PipelineConfig = PipelineConfig(), score=None, follow_all: bool = False) -> DataFrame:
    """Crawl results of all seeds over a page store (url, html[, success, final_url]): reached pages with their scores.

    Unsuccessful pages are dropped; a page goes by its final url. Each page is parsed once, however many seeds reach it.
    """
    from ..functions.urls import normalize_url
    from .heuristics import score_pages

    ok = stored_pages(store)
    edges = written(page_edges(ok.select(F.col("url"), "html"), config, follow_all).drop("kind"), "edges")
    start = seeds.select("seed", normalize_url(F.col("seed"), F.col("seed")).alias("url"))
    reached = expand(start, edges, config.max_depth, config.max_urls_on_level)
    if config.max_pages_per_seed_cap:
        order = Window.partitionBy("seed").orderBy("depth", "pos", "url")
        reached = reached.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= config.max_pages_per_seed_cap).drop("_n")
    wanted = ok.join(reached.select("url").distinct(), "url", "left_semi")
    scored = (score or score_pages)(wanted.withColumnRenamed("url", "key").withColumnRenamed("page_url", "url"))
    cleaned = F.col("cleaned_html") if "cleaned_html" in scored.columns else F.lit(None).cast("string")
    hits = scored.select(F.col("key"), F.col("url").alias("page_url"), "html", cleaned.alias("cleaned_html"), "score", "debug_info", "is_job_listing")
    return reached.join(hits, reached["url"] == hits["key"]).select(
        "seed", "html", "cleaned_html", F.col("page_url").alias("url"), "depth", "pos", "debug_info", "is_job_listing", F.col("score").alias("job_listing_score"), F.lit(None).cast("string").alias("job_listing_metadata")
    )
