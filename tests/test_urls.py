import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteweave.functions import urls

VECTORS = [
    ("/jobs?utm_source=abc&utm_medium=test&foo=bar#section", "https://example.com/careers/", "https://example.com/jobs?foo=bar"),
    ("/jobs?utm_source=a&ref=x&q=1#foo", "https://example.com", "https://example.com/jobs?q=1"),
    ("?a=1&b=2&a=3", "https://x.com/p/", "https://x.com/p?a=1&a=3&b=2"),
    ("/p?x=", "https://x.com", "https://x.com/p"),
    ("/p?q=a b%2Fc&ref=z", "https://x.com", "https://x.com/p?q=a+b%2Fc"),
    ("mailto:a@b.c", "https://x.com", "mailto:a@b.c"),
    ("//CDN.x.com/A/", "https://x.com", "https://cdn.x.com/A"),
    ("HTTP://X.com/A;p?UTM_source=1", "https://x.com", "http://x.com/A;p?UTM_source=1"),
    ("?b=2;c=3", "https://x.com/p", "https://x.com/p?b=2%3Bc%3D3"),
    (" #x", "https://x.com/a", "https://x.com/a"),
    ("../k", "https://x.com/a/b/c", "https://x.com/a/k"),
    ("#x", "https://x.com/a", None),
    ("", "https://x.com/a", None),
    (None, "https://x.com/a", None),
    ("https://a.com/x?fbclid=1&gclid=2&utm_term=3", None, "https://a.com/x?gclid=2&utm_term=3"),
]


def test_vectors(spark):
    df = spark.createDataFrame([(i, h, b) for i, (h, b, _) in enumerate(VECTORS)], "i int, href string, base string")
    got = {r.i: r.n for r in df.select("i", urls.normalize_url(F.col("href"), F.col("base")).alias("n")).collect()}
    assert [got[i] for i in range(len(VECTORS))] == [v[2] for v in VECTORS]
    assert [urls.normalized(h, b) for h, b, _ in VECTORS] == [v[2] for v in VECTORS]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.from_regex(r"https?://[a-zA-Z.]{1,8}(/[a-z;.%~*]{0,4}){0,3}(\?[ab=&+%1~*]{0,8})?(#[a-z]{0,2})?", fullmatch=True), min_size=50, max_size=200))
def test_builtin_and_python_agree(spark, many):
    df = spark.createDataFrame([(u,) for u in many], "u string")
    for r in df.select("u", urls.normalize_url(F.col("u"), F.col("u")).alias("n")).collect():
        assert r.n == urls.normalized(r.u, r.u), r.u


def test_resolve(spark):
    from urllib.parse import urljoin

    cases = [("https://a.com/x/y", h) for h in ("/z", "z", "../z", "//b.com/q", "https://c.com", "https://c.com/d", "?q=1", "/a/../b", "/a;b", "", "/x?")] + [("nourl", "/z"), ("https://a.com", "/ä ö")]
    df = spark.createDataFrame(cases, "b string, h string")
    for r in df.select("b", "h", urls.resolve_url(F.col("b"), F.col("h")).alias("u")).collect():
        assert r.u == urljoin(r.b, r.h), (r.b, r.h)


def test_diff(spark):
    rows = [("https://e.com/careers", c) for c in ("https://e.com/careers/jobs/software", "https://e.com/careers", "https://e.com/careersx", "https://e.com/other")]
    got = [r.d for r in spark.createDataFrame(rows, "p string, c string").select(urls.url_diff(F.col("p"), F.col("c")).alias("d")).collect()]
    assert got == ["jobs/software", "/", "x", None]


@pytest.mark.parametrize(
    "href,target,source,good",
    [
        ("/jobs", "https://a.com/jobs", "https://a.com/", True),
        ("  ", "https://a.com/", "https://b.com/", False),
        (" #x", "https://a.com/", "https://b.com/", False),
        ("x", "ftp://a.com/", "https://b.com/", False),
        ("x", "http://localhost/", "https://b.com/", False),
        ("?page=2", "https://a.com/jobs?page=2", "https://a.com/jobs/", False),
        (None, None, "https://a.com", False),
    ],
)
def test_admissible(spark, href, target, source, good):
    df = spark.createDataFrame([(href, target, source)], "h string, t string, s string")
    assert df.select(urls.admissible(F.col("h"), F.col("t"), F.col("s")).alias("g")).first().g is good


def test_job_links(spark):
    rows = [("/x", "Join our team"), ("/CAREERS", None), ("/x", "vacancy"), ("/x", "about"), (None, "Openings")]
    got = [r.g for r in spark.createDataFrame(rows, "h string, t string").select(urls.is_job_link(F.col("h"), F.col("t")).alias("g")).collect()]
    assert got == [True, True, False, False, True]


def test_host(spark):
    rows = [("https://u:p@A.com:80/x",), ("mailto:x",), (None,)]
    assert [r.h for r in spark.createDataFrame(rows, "u string").select(urls.host(F.col("u")).alias("h")).collect()] == ["u:p@A.com:80", "_", "_"]
