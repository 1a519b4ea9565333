"""The listing score: rules R1 to R10 as expressions over a page's elements. Points are integer tenths until the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import HeuristicConfig
from ..functions.html import links, parse_ruled, regular_links, regular_text, tagged


def _any(text: Column, words: tuple[str, ...]) -> Column:
    """Whether the text contains any of the words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return F.coalesce(hit, F.lit(False))


def _attr(e: Column, name: str) -> Column:
    return F.coalesce(e["attrs"][name], F.lit(""))


def heading_text(rows: Column) -> Column:
    """Lower-cased title, first h1, first five h2 and first five h3, joined by blanks."""
    first = lambda tag, k: F.array_join(F.transform(F.slice(tagged(rows, tag), 1, k), lambda e: e["text_space"]), " ")
    title = F.coalesce(F.get(tagged(rows, "title"), 0)["string"], F.lit(""))
    return F.lower(F.concat_ws(" ", title, first("h1", 1), first("h2", 5), first("h3", 5)))


def url_text(url: Column, config: HeuristicConfig) -> Column:
    """The part of the url that path words are looked for in: its path, or all of it for odd vocabularies."""
    return F.lower(F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)) if config.url_part == "path" else F.lower(url)


def _pager(rows: Column, config: HeuristicConfig) -> tuple[Column, Column, Column]:
    """(a pager class is there, pager words or symbols in links, number of distinct page-number links)."""
    classed = F.exists(tagged(rows, "nav", "div", "ul", "li"), lambda e: _any(F.lower(_attr(e, "class")), config.pager_classes))
    weak = F.slice(F.filter(tagged(rows, "div", "ul"), lambda e: _any(F.lower(_attr(e, "class")), config.weak_pager_classes)), 1, 5)
    within = lambda c: F.slice(F.filter(links(rows), lambda a: (a["pos"] > c["pos"]) & (a["pos"] <= c["end"])), 1, 50)
    some = F.concat(F.slice(links(rows), 1, config.max_links), F.flatten(F.transform(weak, within)))
    # Links alike in attributes and text are one; their order among attributes does not matter.
    alike = F.array_distinct(F.transform(some, lambda a: F.struct(F.array_sort(F.map_entries(a["attrs"])).alias("attrs"), a["text_join"].alias("text"))))
    wordy = lambda a: _any(F.lower(a["text"]), config.pager_words) | _any(a["text"], config.pager_symbols)
    return classed, F.exists(alike, lambda a: (a["text"] != "") & wordy(a)), F.size(F.filter(alike, lambda a: a["text"].rlike(r"(?U)^\d{1,3}$")))


def _form_tenths(rows: Column, config: HeuristicConfig) -> Column:
    """The first of ten forms that has search words (10) or a search-like input among its first twenty (8)."""

    def named(f: Column) -> Column:
        inputs = F.slice(F.filter(tagged(rows, "input", "select"), lambda i: (i["pos"] > f["pos"]) & (i["pos"] <= f["end"])), 1, 20)
        return F.exists(inputs, lambda i: _any(F.lower(F.concat_ws(" ", *(_attr(i, n) for n in ("name", "id", "placeholder", "aria-label")))), config.input_names))

    tenths = F.transform(F.slice(tagged(rows, "form"), 1, 10), lambda f: F.when(_any(F.lower(f["text_space"]), config.form_words), 10).when(named(f), 8).otherwise(0))
    return F.coalesce(F.get(F.filter(tenths, lambda x: x > 0), 0), F.lit(0))


def job_link_count(rows: Column, config: HeuristicConfig) -> Column:
    def counts(a: Column) -> Column:
        href, text = a["attrs"]["href"], a["text_join"]
        words = F.size(F.array_remove(F.split(text, r"\s+"), ""))
        relative = ~(href.startswith("http") | href.startswith("#") | href.startswith("javascript:") | href.startswith("mailto:"))
        return (words >= config.min_words) & (words <= config.max_words) & relative & (F.length(href) > 1) & (_any(F.lower(text), config.title_fragments) | _any(F.lower(href), config.title_fragments))

    return F.size(F.filter(F.slice(links(rows), 1, config.max_links), counts))


def link_tenths(n: Column) -> Column:
    """Two links or more: eight tenths each, forty at most."""
    return F.when(n >= 2, 8 * F.least(n, F.lit(5))).otherwise(0)


def rule_columns(rows: Column, url: Column, config: HeuristicConfig = HeuristicConfig()) -> dict[str, Column]:
    """Tenths by rule, and the counts that the messages name."""
    heading = heading_text(rows)
    strong = _any(heading, config.title_words)
    classed, wordy, numbers = _pager(rows, config)
    n = job_link_count(rows, config)
    r6a, r6b = F.when(wordy, 10).otherwise(0), F.when(numbers >= 3, 5).otherwise(0)
    return {
        "r1": F.when(strong, 15).otherwise(0),
        "r2": F.when(_any(heading, config.single_job_words), -10).otherwise(0),
        "r3": F.when(_any(heading, config.general_words) & ~strong, 5).otherwise(0),
        "r4": F.when(_any(url_text(url, config), config.url_paths), 10).otherwise(0),
        "r5": F.when(classed, 15).otherwise(0),
        "r6a": F.when(classed, 0).otherwise(r6a),
        "r6b": F.when(classed, 0).otherwise(r6b),
        "r7": _form_tenths(rows, config),
        "r9": link_tenths(n),
        "page_numbers": numbers,
        "job_links": n,
    }


def total_score() -> Column:
    """Sum of the rules; R6 counts twelve tenths at most."""
    return F.round((F.col("r1") + F.col("r2") + F.col("r3") + F.col("r4") + F.col("r5") + F.least(F.col("r6a") + F.col("r6b"), F.lit(12)) + F.col("r7") + F.col("r9")) / 10, 2)


def messages() -> Column:
    """Fired rules, in rule order."""
    fired = lambda c, text: F.when(F.col(c) != 0, text if isinstance(text, Column) else F.lit(text))
    return F.array_compact(
        F.array(
            fired("r1", "+1.5 listing word in title or headings"),
            fired("r2", "-1.0 single-job phrase in title or headings"),
            fired("r3", "+0.5 general listing word in title or headings"),
            fired("r4", "+1.0 listing word in url"),
            fired("r5", "+1.5 pager class"),
            fired("r6a", "+1.0 pager words or symbols in links"),
            fired("r6b", F.format_string("+0.5 page numbers in %d links", "page_numbers")),
            F.when(F.col("r7") == 10, "+1.0 search words in form").when(F.col("r7") == 8, "+0.8 search inputs in form"),
            fired("r9", F.format_string("+%.1f job words in %d links", F.col("r9") / 10, "job_links")),
        )
    )


def score_pages(pages: DataFrame, config: HeuristicConfig = HeuristicConfig(), html: str = "html", url: str = "url") -> DataFrame:
    """Adds the rules, ``score``, ``debug_info`` and ``is_job_listing`` to each page. One parse a page, no shuffle.

    A page that cannot be parsed (null html) has no elements and scores by its url alone.
    """
    df = pages.withColumn("_elements", parse_ruled(F.col(html)))
    df = df.withColumns(rule_columns(F.col("_elements"), F.col(url), config)).drop("_elements")
    return df.withColumns({"score": total_score(), "debug_info": messages()}).withColumn("is_job_listing", F.col("score") > config.threshold)


def score_listing(spark: SparkSession, html: str, url: str | None = None, config: HeuristicConfig = HeuristicConfig()) -> tuple[float, list[str]]:
    """(score, messages) of one page."""
    row = score_pages(spark.createDataFrame([(html, url)], "html string, url string"), config).first()
    return row.score, row.debug_info


def score_regular(pages: DataFrame, config: HeuristicConfig = HeuristicConfig()) -> DataFrame:
    """The same rules in the JVM alone, for pages with plain anchors and headings and no forms (no parse, no Python)."""
    df = pages.withColumns({"_links": regular_links(F.col("html")), "_heading": F.concat_ws(" ", regular_text(F.col("html"), "title"), regular_text(F.col("html"), "h1"))})
    df = df.withColumn("_heading", F.concat("_heading", F.lit("  ")))
    strong = _any(F.col("_heading"), config.title_words)
    some = F.slice("_links", 1, config.max_links)
    alike = F.array_distinct(F.transform(some, lambda a: F.struct(a["href"], F.trim(a["text"]).alias("text"))))
    wordy = F.exists(alike, lambda a: (a["text"] != "") & (_any(F.lower(a["text"]), config.pager_words) | _any(a["text"], config.pager_symbols)))

    def counts(a: Column) -> Column:
        words = F.size(F.array_remove(F.split(a["text"], r"\s+"), ""))
        return (words >= config.min_words) & (words <= config.max_words) & ~a["href"].rlike(r"^(http|#|javascript:|mailto:)") & (F.length(a["href"]) > 1) & (_any(F.lower(a["text"]), config.title_fragments) | _any(F.lower(a["href"]), config.title_fragments))

    classed = F.lit(False)
    for word in config.pager_classes:
        classed = classed | F.col("html").rlike(rf"(?i)<(?:nav|div|ul|li)\b[^>]*\bclass=\"[^\"]*{word}")
    df = df.withColumns({"page_numbers": F.size(F.filter(alike, lambda a: a["text"].rlike(r"(?U)^\d{1,3}$"))), "job_links": F.size(F.filter(some, counts)), "_classed": classed})
    df = df.withColumns(
        {
            "r1": F.when(strong, 15).otherwise(0),
            "r2": F.when(_any(F.col("_heading"), config.single_job_words), -10).otherwise(0),
            "r3": F.when(_any(F.col("_heading"), config.general_words) & ~strong, 5).otherwise(0),
            "r4": F.when(_any(url_text(F.col("url"), config), config.url_paths), 10).otherwise(0),
            "r5": F.when(F.col("_classed"), 15).otherwise(0),
            "r6a": F.when(~F.col("_classed") & wordy, 10).otherwise(0),
            "r6b": F.when(~F.col("_classed") & (F.col("page_numbers") >= 3), 5).otherwise(0),
            "r7": F.lit(0),
            "r9": link_tenths(F.col("job_links")),
        }
    )
    df = df.withColumns({"score": total_score(), "debug_info": messages()}).drop("_links", "_heading", "_classed")
    return df.withColumn("is_job_listing", F.col("score") > config.threshold)


def best_per_seed(scored: DataFrame, seed: str, order: tuple[str, ...] = ()) -> DataFrame:
    """The top page of each seed: highest score, shortest url, then crawl order. It may turn out to be no listing.

    One partial aggregation, no sort: only the winner's columns travel.
    """
    rank = F.struct((-F.col("score")).alias("a"), F.length("url").alias("b"), *(F.col(c) for c in order), F.col("url").alias("z"))
    others = [c for c in scored.columns if c != seed]
    best = scored.groupBy(seed).agg(F.min_by(F.struct(*others), rank).alias("_best"))
    return best.select(seed, *(F.col(f"_best.{c}").alias(c) for c in others))


def ranked(scored: DataFrame, seed: str, order: tuple[str, ...] = ()) -> DataFrame:
    """All pages with their rank in the same order."""
    w = Window.partitionBy(seed).orderBy(F.desc("score"), F.length("url"), *order, "url")
    return scored.withColumn("rank", F.row_number().over(w))


def report_lines(seeds: DataFrame, best: DataFrame, seed: str = "seed") -> DataFrame:
    """One text line per seed: ``seed url score`` of its listing, or ``seed NA NA``."""
    found = best.where("is_job_listing").select(F.col(seed).alias("_s"), F.col("url").alias("_u"), F.col("score").alias("_n"))
    joined = seeds.join(found, seeds[seed] == F.col("_s"), "left")
    return joined.select(seed, F.concat_ws(" ", seed, F.coalesce("_u", F.lit("NA")), F.coalesce(F.col("_n").cast("string"), F.lit("NA"))).alias("line"))
