import pytest
from pyspark.sql import functions as F

from siteweave.config import HeuristicConfig
from siteweave.functions import html, selectors, text
from siteweave.operators import heuristics


def scored(spark, body, url="https://example.com/x"):
    row = heuristics.score_pages(spark.createDataFrame([(url, body)], "url string, html string")).first()
    return row.score, row.debug_info


def test_golden_page(spark):
    body = '<html><head><title>Jobs</title></head><body><h1>Careers</h1><nav class="pagination">Next</nav><a href="/jobs/1">Software Engineer</a><a href="/jobs/2">Nurse</a></body></html>'
    score, said = heuristics.score_listing(spark, body, "https://example.com/jobs")
    assert score == 4.0 and len(said) == 3


@pytest.mark.parametrize(
    "body,score",
    [
        ("<title>Jobs</title>", 1.5),
        ("<title>Apply now</title>", -1.0),
        ("<h2>results</h2>", 0.5),
        ("<title>job</title><h3>results</h3>", 1.5),
        ("<title>a<b>job</b></title>", 0.0),
        ('<ul class="x pager-big"></ul>', 1.5),
        ('<a href="/a">Next</a>', 1.0),
        ('<a href="/1">1</a><a href="/2">2</a><a href="/3">3</a>', 0.5),
        ('<a href="/1">1</a><a href="/1">1</a><a href="/3">3</a>', 0.0),
        ('<a href="/1">1</a><a href="/2">2</a><a href="/3">3</a><a href="/n">»</a>', 1.2),
        ("<form>Search Jobs</form>", 1.0),
        ('<form><input name="q"></form>', 0.8),
        ('<form>x</form><form><select id="city"></select></form><form>find jobs</form>', 0.8),
        ('<a href="/a">Senior Engineer</a><a href="/b">Head Nurse</a>', 1.6),
        ('<a href="/a">Engineer</a><a href="http://b">Head Nurse</a>', 0.0),
        ("".join(f'<a href="/a{i}">Senior Engineer</a>' for i in range(9)), 4.0),
        ("<script>var t='<title>jobs</title>'</script>", 0.0),
        (None, 0.0),
    ],
)
def test_rules(spark, body, score):
    assert scored(spark, body)[0] == score


def test_url_rule_reads_the_path_alone(spark):
    assert scored(spark, "", "https://jobs.com/?x=/jobs")[0] == 0.0
    assert scored(spark, "", "https://a.com/OPENINGS/1")[0] == 1.0
    assert scored(spark, "", None)[0] == 0.0


def test_tree():
    d = html.Document("<div><p>a<br>b<p>c</div><p>d</i></p><script>'</p>'</script>")
    assert [(n.tag, n.parent, n.end) for n in d.nodes] == [("div", -1, 3), ("p", 0, 3), ("br", 1, 2), ("p", 1, 3), ("p", -1, 4), ("script", -1, 5)]
    assert d.texts(d.nodes[0]) == ["a", "b", "c"]
    assert html.minified("<p>x</p>") == "" and html.minified(None) == ""
    assert html.minified('<body><header>h</header><p class="a&quot;b">x &amp; y<img src=q></p><svg><path/></svg></body>') == '<p class="a&quot;b">x &amp; y</p>'
    deep = "<div>" * 5000 + "x"
    assert html.minified(f"<body>{deep}</body>").count("<div>") == 5000


PAGE = '<div id="root"><ul class="a b"><li><a class="job" href="/1">One</a></li><li><a class="job x" href="/2?q">Two <b>more</b></a></li><li><a class="job" href="/1">Again</a></li></ul></div><a class="job" href="/9">Out</a>'


@pytest.mark.parametrize(
    "container,child,urls",
    [
        ("#root", "a.job", ["/1", "/2?q"]),
        ("div, section", "ul.a > li > a[href]", ["/1", "/2?q"]),
        ("#root", "a[href*='?']", ["/2?q"]),
        ("#root", "li:first-child a", ["/1"]),
        ("#root", "li + li a.x", ["/2?q"]),
        ("#root", "a:not(.x)", ["/1"]),
        ("#root", "li:nth-child(2) a", ["/2?q"]),
        ("#none", "a", None),
        ("#root", "a[", None),
        (" ", "a", None),
    ],
)
def test_selectors(spark, container, child, urls):
    got = selectors.job_links(PAGE, "https://e.com/x", container, child, False)
    assert (got and [g["url"] for g in got]) == (urls and [f"https://e.com{u}" for u in urls])
    df = spark.createDataFrame([(PAGE, "https://e.com/x", container, child)], "h string, b string, c string, k string")
    one = df.select(selectors.static_links("h", "b", "c", "k").alias("l")).first().l
    assert (one and [x.url for x in one]) == (urls and [f"https://e.com{u}" for u in urls])


def test_whole_page_mode():
    assert [x["url"] for x in selectors.job_links(PAGE, "https://e.com/", "#root", ".job", True)] == ["https://e.com/1", "https://e.com/2?q", "https://e.com/9"]
    assert selectors.job_links(PAGE, "https://e.com/", "#root", ".job", True)[1]["title"] == "Twomore"
    assert selectors.syntax_error("div[") and selectors.syntax_error("") and selectors.syntax_error("a,,b") and not selectors.syntax_error("ul > li ~ a[x='1' i]")


@pytest.mark.parametrize("n", [0, 1, 10, 11, 17, 18, 19, 20, 21, 80, 90])
@pytest.mark.parametrize("lossy", [True, False])
def test_chunks(spark, n, lossy):
    whole = "".join(chr(97 + i % 26) for i in range(n))
    got = text.chunks(spark.createDataFrame([(1, whole)], "k int, t string"), "t", "k", 10, 2, 8, lossy).orderBy("chunk_idx").collect()
    want = [(i // 10, (s := i - 2 if i else 0), whole[s : s + 10]) for i in range(0, n, 10)][:8]
    if not lossy and want:
        want[-1] = (*want[-1][:2], whole[want[-1][1] :])
    assert [(r.chunk_idx, r.start, r.chunk) for r in got] == want


def test_markdown():
    body = "<body><nav><p>one two three four five six</p></nav><h1>Head</h1><p>too short</p><p>this block has more than five words</p><p><a href=x>only linked words are in this block</a></p><ul><li>a list item with more than five words</li></ul></body>"
    assert text.to_markdown(body) == "# Head\n\nthis block has more than five words\n\n- a list item with more than five words"


def test_rate_limit(spark):
    rows = [("HTTP 429",), ("Resource Exhausted",), ("rate is the limit",), ("rate",), (None,)]
    assert [r.x for r in spark.createDataFrame(rows, "m string").select(text.is_rate_limit(F.col("m")).alias("x")).collect()] == [True, True, True, False, False]


def test_builtin_score_agrees(spark):
    body = '<title>the thing</title><h1>x</h1><a href="/the">la</a><a href="/en">b c</a><a href="/1">1</a>'
    config = HeuristicConfig(title_words=("the",), single_job_words=("thing",), pager_words=("la",), title_fragments=("th", "en"), min_words=1)
    df = spark.createDataFrame([("https://a.com/jobs", body)], "url string, html string")
    a, b = heuristics.score_pages(df, config).first(), heuristics.score_regular(df, config).first()
    assert (a.score, a.debug_info) == (b.score, b.debug_info) and a.score != 0
