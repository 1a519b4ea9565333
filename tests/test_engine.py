import json

import pytest
from pyspark.sql import functions as F
from synthetic_site import listing, site

from siteweave.config import PipelineConfig, RetryPolicy, Settings, parse_headers
from siteweave.functions import validate
from siteweave.operators import extract, frontier, heuristics, merge, paging, telemetry
from siteweave.plans.pipeline import Pipeline
from siteweave.sources import store
from siteweave.streaming import queue


def test_config():
    c = PipelineConfig.from_env({"SEED_URLS": " a, ,b ", "MAX_DEPTH": "3", "LLM_API_KEY": " ", "API_KEY_GEMINI": " k ", "LOSSY_TAIL": "no", "UNKNOWN": "x"}, dotenv="/nonexistent")
    assert c.seeds == ["a", "b"] and c.max_depth == 3 and c.api_key == "k" and not c.lossy_tail
    c.check_models()
    with pytest.raises(ValueError):
        PipelineConfig(max_depth=101)
    with pytest.raises(ValueError):
        PipelineConfig().check_models()
    with pytest.raises(ValueError):
        PipelineConfig(llm_api_key="k", llm_model_listing=" ").check_models()
    assert Settings(output_dir="o/").details_path == "o/job_details.jsonl"
    assert Settings.from_env({"OUTPUT_DIR": "p", "QUEUE_DIR": "q"}, dotenv="/nonexistent") == Settings("p", "", "q")
    assert parse_headers("") is None and parse_headers('{"a": 1}') == {"a": "1"}
    with pytest.raises(ValueError):
        parse_headers('["x"]')


def answer(**changes):
    base = {"is_job_listing": True, "score": 5, "has_pagination": False, "parent_container_selector": "#root", "individual_job_links": [{"href": "/1", "text": "x", "selector": "a.job"}]}
    return json.dumps(base | changes)


@pytest.mark.parametrize(
    "text,kind",
    [
        (answer(), None),
        (answer(is_job_listing=False, individual_job_links=[{"href": "", "text": "", "selector": "div["}]), None),
        (answer(individual_job_links=[{"href": "/1", "text": "x", "selector": "div["}]), "domain"),
        (answer(child_job_link_selector="a, b"), "domain"),
        (answer(parent_container_selector=""), "domain"),
        (answer(has_pagination=True, next_page_element={"text": "", "href": "", "selector": ""}), "domain"),
        (answer(is_job_listing="yes", score="7.5", has_pagination=1), None),
        (answer(score="much"), "schema"),
        (answer(parent_container_selector=None), "schema"),
        (answer(total_token_count=7.5), "schema"),
        (answer(total_token_count=7.0), None),
        (answer(individual_job_links=None), "schema"),
        ("{", "json"),
        (None, "json"),
        ("[]", "schema"),
    ],
)
def test_listing_validation(text, kind):
    assert validate.validator_for("listing").validate_json(text)[1] == kind


def test_details_validation(spark):
    good = {k: "x" for k in ("jobtitle", "location", "required_skills", "compensation", "benefits")}
    rows = [good | {"salary": None}, good | {"jobtitle": "  "}, good | {"location": 3}, {}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, t string")
    got = [r.k for r in df.select("i", validate.validate_details("t")["error_kind"].alias("k")).orderBy("i").collect()]
    assert got == [None, "domain", "schema", "schema"]
    with pytest.raises(KeyError):
        validate.validator_for("unknown")
    validate.register("custom", validate.Validator(lambda v: v))
    assert validate.validator_for("custom").validate({"a": 1}) == {"a": 1}


class Script:
    """A model that follows a script of answers and errors."""

    def __init__(self, *steps):
        self.steps, self.seen = list(steps), []

    def complete(self, messages):
        self.seen.append(messages)
        step = self.steps.pop(0)
        if isinstance(step, Exception):
            raise step
        return step, extract.Usage(1, 2, 3)


def test_invoke_rounds():
    waits = []
    policy = RetryPolicy(2, 500)
    model = Script(Exception("429"), "{", answer(score="x"), answer())
    out = extract.invoke(model, "s", "p", "listing", policy, waits.append)
    assert out.value and out.attempts == 3 and out.usage.total_tokens == 3 and out.all_calls_tokens == 9 and 0.5 <= waits[0] < 0.75
    assert [m["role"] for m in model.seen[-1]] == ["system", "user", "assistant", "user", "assistant", "user"]
    assert extract.invoke(Script(Exception("broken")), "s", "p", "listing", policy, waits.append).error_kind == "transport"
    out = extract.invoke(Script("{", "{", "{"), "s", "p", "listing", policy, waits.append)
    assert out.value is None and out.error_kind == "json" and out.attempts == 3
    assert extract.invoke(Script(*[Exception("rate limit")] * 3), "s", "p", "listing", policy, lambda s: None).error_kind == "transport"
    assert extract.invoke(Script(""), "s", "p", "listing", RetryPolicy(0), waits.append).error_kind == "schema"
    assert extract.usage_of({"prompt_tokens": 11, "completion_tokens": 7, "total_tokens": 18}) == extract.Usage(11, 7, 18) and extract.usage_of(None) == extract.Usage()


def test_session():
    s = extract.Session()
    for role in ("system", "user", "assistant"):
        s.say(role, role)
    copy = s.messages
    copy[0]["content"] = "changed"
    assert [m["content"] for m in s.messages] == ["system", "user", "assistant"]
    s.reset()
    assert s.messages == []


def test_merge(spark):
    link = lambda h: {"href": h, "text": h, "selector": "a"}
    base = {"page_key": "p", "careers_url": ""}
    rows = [
        base | {"chunk_idx": 1, "is_job_listing": True, "score": 7.0, "has_pagination": False, "parent_container_selector": "", "next_page_element": {"text": "no", "href": "no", "selector": "no"}, "individual_job_links": [link("/1"), link("/2")], "child_job_link_selector": "", "total_token_count": 20},
        base | {"chunk_idx": 0, "is_job_listing": True, "score": 5.0, "has_pagination": True, "parent_container_selector": "div", "next_page_element": {"text": "n", "href": "/p", "selector": "a"}, "individual_job_links": [link("/1"), link("/1")], "child_job_link_selector": "a", "total_token_count": 10},
        base | {"chunk_idx": 2, "is_job_listing": False, "score": 9.0, "has_pagination": True, "parent_container_selector": "x", "next_page_element": None, "individual_job_links": [link("/9")], "child_job_link_selector": "x", "total_token_count": 99},
        base | {"page_key": "q", "chunk_idx": 0, "is_job_listing": None, "score": None, "has_pagination": None, "parent_container_selector": None, "next_page_element": None, "individual_job_links": None, "child_job_link_selector": None, "total_token_count": None},
    ]
    from siteweave.schemas import CHUNK_RESPONSE

    got = {r.page_key: r for r in merge.merge_chunks(spark.createDataFrame(rows, CHUNK_RESPONSE), "https://e.com").collect()}
    p, q = got["p"], got["q"]
    assert (p.is_job_listing, p.score, p.has_pagination, p.parent_container_selector, p.next_page_element.href) == (True, 7.0, True, "div", "/p")
    assert [x.href for x in p.individual_job_links] == ["/1", "/2"] and p.child_job_link_selector == "" and p.total_token_count == 30 and p.careers_url == "https://e.com"
    assert (q.is_job_listing, q.score, q.has_pagination, q.parent_container_selector, q.next_page_element, q.individual_job_links, q.child_job_link_selector, q.total_token_count) == (False, 0.0, False, "", None, [], None, 0)


def test_budget_and_sessions(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate([4, None, 6, 1])], "k int, i int, t int")
    assert [r.i for r in merge.within_budget(df, "t", 10, "k", "i").orderBy("i").collect()] == [0, 1, 2]
    assert merge.detail_tokens(spark.createDataFrame([("a", None), ("b", 3)], "k string, total_token_count long"), "k").orderBy("k").collect() == [("a", None, 1), ("b", 3, 1)]


def test_paging(spark):
    rows = [("a", 1, [], True), ("a", 2, ["x"], True), ("a", 3, ["y", "x"], True), ("a", 4, ["x", "y", "y"], True), ("a", 5, ["z"], True), ("b", 1, ["x"], True), ("b", 2, None, True), ("b", 3, ["y"], True), ("c", 1, ["x"], False), ("c", 2, ["y"], True)]
    df = spark.createDataFrame(rows, "site string, page_no int, urls array<string>, more boolean")
    got = sorted((r.site, r.page_no) for r in paging.pages_until_stop(df, more="more").collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("c", 1)]


def test_bfs(spark):
    edges = spark.createDataFrame([("a", "b", 0), ("a", "c", 1), ("b", "a", 0), ("b", "d", 1), ("c", "d", 0), ("d", "e", 0), ("x", "a", 0)], "source_url string, url string, pos long")
    seeds = spark.createDataFrame([("a", "a"), ("x", "x"), ("lonely", "lonely")], "seed string, url string")
    got = sorted((r.seed, r.url, r.depth, r.source_url) for r in frontier.expand(seeds, edges, 2).collect())
    assert got == [("a", "a", 0, None), ("a", "b", 1, "a"), ("a", "c", 1, "a"), ("a", "d", 2, "b"), ("lonely", "lonely", 0, None), ("x", "a", 1, "x"), ("x", "b", 2, "a"), ("x", "c", 2, "a"), ("x", "x", 0, None)]
    capped = sorted(r.url for r in frontier.expand(seeds.where("seed = 'a'"), edges, 2, level_cap=0).collect())
    assert capped == ["a", "b", "d"]


def test_best(spark):
    df = spark.createDataFrame([("s", "long/url", 4.0, 0), ("s", "url1", 4.0, 2), ("s", "url0", 4.0, 3), ("t", "u", 1.0, 0)], "seed string, url string, score double, pos int").withColumn("is_job_listing", F.col("score") > 3)
    best = heuristics.best_per_seed(df, "seed", ("pos",))
    assert sorted((r.seed, r.url) for r in best.collect()) == [("s", "url1"), ("t", "u")]
    assert [r.url for r in heuristics.ranked(df, "seed", ("pos",)).where("seed = 's'").orderBy("rank").collect()] == ["url1", "url0", "long/url"]
    lines = heuristics.report_lines(spark.createDataFrame([("s",), ("t",), ("u",)], "seed string"), best)
    assert sorted(r.line for r in lines.collect()) == ["s url1 4.0", "t NA NA", "u NA NA"]


def test_scrape(spark):
    own = [{"href": "/own", "text": "own", "selector": "a"}, {"href": "/own", "text": "again", "selector": "a"}]
    rows = [("static", "https://e.com/jobs", listing("e", 3), False, "#list", "a.job"), ("own", "https://e.com/jobs", "<p>", False, "#list", "a.job"), ("paged", "https://e.com/jobs", listing("e", 2), True, "#list", "a.job")]
    df = spark.createDataFrame([(*r, own) for r in rows], "page_key string, careers_url string, html string, has_pagination boolean, parent_container_selector string, child_job_link_selector string, individual_job_links array<struct<href:string,text:string,selector:string>>")
    assert {r.page_key: r.mode for r in paging.route(df).collect()} == {"static": "static", "own": "static", "paged": "browser"}
    stored = spark.createDataFrame([("paged", 1, listing("e", 2), True), ("paged", 2, listing("e", 4), True), ("paged", 3, listing("e", 4), True), ("paged", 4, listing("e", 9), True)], "page_key string, page_no int, html string, next_usable boolean")
    got: dict = {}
    for r in paging.scrape(df, stored).orderBy("page_key", "pos").collect():
        got.setdefault(r.page_key, []).append((r.url, r.title))
    assert got["static"] == [(f"https://e.com/jobs/{i}", f"Software Engineer {i}") for i in range(3)]
    assert got["own"] == [("https://e.com/own", "own")]
    assert [u for u, _ in got["paged"]] == [f"https://e.com/jobs/{i}" for i in range(4)]


def test_pipeline_end_to_end(spark, tmp_path):
    rows = site() + [("https://other.org/", "<p>nothing here</p>")]
    pages = spark.createDataFrame(rows, "url string, html string")
    config = PipelineConfig(seed_urls="https://careers.acme.com/,https://other.org/,https://gone.net/", listing_chunk_sleep_ms=0, listing_cache_dir=f"file://{tmp_path}/cache")
    out = Pipeline(spark, config).run(pages, output=f"file://{tmp_path}/out")
    crawled = {(r.url, r.depth) for r in out.crawled.collect()}
    assert ("https://careers.acme.com/jobs", 2) in crawled and ("https://careers.acme.com/careers", 1) in crawled and not any("lost" in u for u, _ in crawled)
    assert sorted(r.line.split()[1] for r in out.report.collect()) == ["NA", "NA", "https://careers.acme.com/jobs"]
    one = out.listings.first()
    assert one.is_job_listing and one.has_pagination and not one.cache_hit
    assert out.links.count() == 14 and out.details.count() == 9  # the first link is of a page that is not stored
    events = [json.loads(r.value) for r in spark.read.text(f"file://{tmp_path}/out/stage_events").collect()]
    assert any(e["stage"] == "listing_llm" and e.get("cache_hit") is False and e["chunks"] >= 1 and e["url"] for e in events if "url" in e)
    assert any(e["stage"] == "job_links_scrape" and e.get("mode") == "browser" and e["count"] == 14 for e in events) and any(e["stage"] == "post_crawl_analyze" and e["phase"] == "full" for e in events)
    titles = {r.details.jobtitle for r in out.details.collect()}
    assert "Software Engineer 0" in titles
    assert spark.read.text(f"file://{tmp_path}/out/career_listings").count() == 3
    assert {json.loads(r.value)["stage"] for r in spark.read.text(f"file://{tmp_path}/out/stage_events").collect()} >= {"pipeline_start", "bfs_crawl", "listing_llm", "job_links_scrape", "job_details_llm", "pipeline_end"}
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out/job_links").columns[:2] == ["Title", "URL"]
    bare = spark.createDataFrame([("https://a", None, None, None), ("https://b", 2, 'say "x", y', "/2"), ("https://b", 1, None, "/1")], "careers_url string, pos int, title string, url string")
    store.write_links_csv(bare, f"file://{tmp_path}/csv")
    files = {f.parent.name: f.read_text() for f in (tmp_path / "csv").glob("*/part-*")}
    import csv
    import hashlib

    assert {k: list(csv.reader(v.splitlines())) for k, v in files.items()} == {
        f"job_links={hashlib.md5(u.encode()).hexdigest()}": rows for u, rows in (("https://a", [["Title", "URL"]]), ("https://b", [["Title", "URL"], ["", "/1"], ['say "x", y', "/2"]]))
    }
    again = Pipeline(spark, config).analyze(out.best.withColumn("page_key", F.col("url")))
    assert again.first().cache_hit


def test_cache_splits(spark, tmp_path):
    pages = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "url string, html string")
    cache = pages.where("url = 'a'").select(F.sha2(F.col("html").cast("binary"), 256).alias("content_sha256"), F.col("url").alias("careers_url"))
    hits, misses = store.split_by_cache(pages, cache)
    assert sorted(r.careers_url for r in hits.collect()) == ["a", "a"] and [r.url for r in misses.collect()] == ["c"]
    assert store.read_cache(spark, f"file://{tmp_path}/none").count() == 0
    listing = pages.where("url = 'a'").select("html", F.lit(True).alias("is_job_listing"), F.lit("u").alias("careers_url"))
    for score in (9.0, 1.0):
        store.save_cache(listing.withColumn("score", F.lit(score)), f"file://{tmp_path}/cache")
    assert [r.score for r in store.read_cache(spark, f"file://{tmp_path}/cache").collect()] == [1.0]


def test_stored_pages(spark):
    rows = [("https://e.com/x?utm_source=1", "first", True), ("https://e.com/x/", "second", True), ("https://e.com/y", "own", True), ("https://e.com/y/", "other", True), ("https://e.com/y#a", "third", True)]
    rows += [("https://e.com/z", "same", True), ("https://e.com/z", "same", True), ("https://e.com/bad", "b", False), (None, "n", True), ("https://e.com/null", None, True)]
    got = {r.url: (r.page_url, r.html) for r in frontier.stored_pages(spark.createDataFrame(rows, "url string, html string, success boolean")).collect()}
    assert got == {"https://e.com/x": ("https://e.com/x/", "second"), "https://e.com/y": ("https://e.com/y", "own"), "https://e.com/z": ("https://e.com/z", "same"), "https://e.com/null": ("https://e.com/null", None)}
    assert frontier.stored_pages(spark.createDataFrame([], "url string, html string")).count() == 0


def test_distinct_links(spark):
    link = "struct<href:string,text:string>"
    rows = [("a", [("/2", "x"), ("/1", "y"), ("/2", "z"), (None, "n"), ("/1", None)]), ("b", []), ("c", None)]
    df = spark.createDataFrame(rows, f"k string, links array<{link}>").select("k", merge.distinct_links(F.col("links")).alias("links"))
    assert {r.k: r.links and [tuple(x) for x in r.links] for r in df.collect()} == {"a": [("/2", "x"), ("/1", "y")], "b": [], "c": None}
    many = spark.range(1).select(merge.distinct_links(F.transform(F.sequence(F.lit(0), F.lit(30_000)), lambda i: F.struct((i % 20_000).cast("string").alias("href"), i.alias("i")))).alias("l"))
    assert [x.i for x in many.first().l] == list(range(20_000))


def test_fetch_options(spark):
    html = '<style>p{}</style><p>a</p><a href="https://www.facebook.com/x">f</a><a class=b href=//x.com>y</a><a href="https://notx.com/">n</a>'
    df = spark.createDataFrame([("u", html), ("v", None)], "url string, html string")
    assert [r.html for r in store.as_fetched(df).orderBy("url").collect()] == ['<p>a</p><a href="https://notx.com/">n</a>', None]
    assert store.as_fetched(df, store.FetchOptions(styles=True, social_links=True)).orderBy("url").first().html == html


def test_models_are_checked(spark):
    with pytest.raises(ValueError):
        Pipeline(spark, PipelineConfig(), listing_model=lambda: Script(), details_model=lambda: Script()).run(spark.createDataFrame([], "url string, html string"))


def test_fetch(spark):
    def make():
        return lambda batch: ({"url": u, "html": f"<p>{u}</p>"} if "bad" not in u else {"url": u, "success": False} for u in batch)

    got = {r.url: r for r in store.fetch(spark.createDataFrame([("http://a/1",), ("http://a/bad",), ("http://a/1",)], "url string"), make).collect()}
    assert got["http://a/1"].success and got["http://a/1"].final_url == "http://a/1" and not got["http://a/bad"].success and len(got) == 2


def test_tables(spark):
    assert [r.seed for r in store.seeds(spark, " a,, b ").collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        store.crawl_run(spark, "r", "s", "odd", None)
    assert store.crawl_run(spark, "r", "s", "ok", None).count() == 1
    rows = spark.createDataFrame([("s", "https://e.com/l", "https://e.com/j?utm_source=1", "t")], "seed string, listing_url string, url string, title string")
    job = store.jobs(rows, "run").first()
    assert job.job_url == "https://e.com/j" and len(job.id) == 64


def test_events(spark):
    log = telemetry.StageLog(spark, "r")
    with log.stage("one", seed="s") as extra:
        extra["tokens"], extra["cache_hit"] = 7, True
    with pytest.raises(KeyError), log.stage("two"):
        raise KeyError("x")
    lines = [json.loads(r.value) for r in telemetry.event_lines(log.events()).collect()]
    assert lines[0]["tokens"] == 7 and lines[0]["cache_hit"] is True and "url" not in lines[0] and lines[1]["error"] == "KeyError"


def test_queue(spark, tmp_path):
    pages = spark.createDataFrame(site(jobs=3), "url string, html string")
    folder, out = f"file://{tmp_path}/queue", f"file://{tmp_path}/out"
    queue.enqueue(spark, folder, task="extract_job_details", payload={"job_urls": ["https://careers.acme.com/jobs/0", "https://careers.acme.com/none"]})
    queue.enqueue(spark, folder, task="analyze_listing", payload={"url": "https://careers.acme.com/jobs", "html": listing("x", 3)})
    queue.enqueue(spark, folder, task="unknown", payload={})
    worker = queue.Worker(spark, pages, PipelineConfig(listing_chunk_sleep_ms=0), out)
    queue.start(worker, folder, f"file://{tmp_path}/checkpoint", once=True).awaitTermination(180)
    got = {r.task: (r.status, r.result) for r in spark.read.json(f"{out}/task_results").collect()}
    assert got["extract_job_details"] == ("ok", '{"job_rows": 1}') and got["analyze_listing"][0] == "ok" and got["unknown"][0] == "error"


def test_page_stream(spark, tmp_path):
    folder = f"file://{tmp_path}/pages"
    spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "url string, html string").coalesce(1).write.parquet(folder)
    stream = queue.page_stream(spark, folder, "url string, html string")
    run = stream.writeStream.format("memory").queryName("seen_pages").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("seen_pages").count() == 2


def test_cli():
    from siteweave.plans.cli import parser

    assert parser().parse_args(["run-pipeline", "--pages", "p"]).pages == "p"
    with pytest.raises(SystemExit):
        parser().parse_args([])
