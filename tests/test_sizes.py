"""What larger tables bring: long bodies, odd references, large batches, many files."""

import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from test_queries import rows

from siteweave import queries as engine
from siteweave.functions import html
from siteweave.operators import extract, frontier
from siteweave.sources import store


def against_sql(spark, folder, name: str, pages: list[tuple[int, str, str]]) -> None:
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
    got = engine.QUERIES[name](spark, str(folder)).toPandas()
    assert rows(got) == rows(con.execute(engine.ORACLES[name]).df()) and len(got)


LINK = '<a href="/link">x</a>'


@pytest.mark.parametrize("name", ["listing_chunks", "analyze_twice"])
def test_long_bodies(spark, tmp_path, name):
    """Links in the part that two chunks share, across the place where chunks meet, one in each of two chunks, and in the tail."""
    bodies = [LINK, LINK * 2, "y" * 99_500 + LINK + "y" * 5_000, "y" * 99_500 + LINK * 2 + "y" * 5_000, LINK + "y" * 150_000 + LINK]
    bodies += ["y" * 198_990 + LINK * 2 + "y" * 50_000, LINK + "y" * 199_500 + LINK, LINK * 2 + "y" * 950_000 + LINK]
    against_sql(spark, tmp_path, name, [(i, f"https://e.com/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)])


def test_references_without_end(spark, tmp_path):
    bodies = ["a &amp b", "a&amp</b>", "&amp;amp; &lt &lt;x&gt; &copy &copy; &eacute; &#39; & &&amp;", "&amp;lt; &notit;"]
    against_sql(spark, tmp_path, "minify_body_dom", [(i, "u", f"<body><b>{b}</b></body>") for i, b in enumerate(bodies)])


PAGE = "<title>t</title><nav><ul>" + LINK * 6 + "</ul></nav>" + "<p>some words <b>here</b></p>" * 10


def held(f, *columns) -> int:
    tracemalloc.start()
    f(*columns)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("name", ["parse_html", "parse_ruled", "parse_links"])
def test_objects_of_a_slice_alone(name):
    """A batch of eight times the pages takes no more Python objects at once."""
    f = getattr(html, name).__wrapped__
    batch = lambda n: [pa.array([PAGE] * n)] + ([pa.array(["https://e.com/"] * n)] if name == "parse_links" else [])
    assert held(f, *batch(2400)) < 4 * held(f, *batch(300))


def test_slices():
    sizes = [0, 1, 63, 64, 65, 200]
    assert [[n for _, n in html.slices(pa.array(["x"] * k, pa.string()))] for k in sizes] == [[], [1], [63], [64], [64, 1], [64, 64, 64, 8]]
    big = "x" * html.SLICE_BYTES
    assert list(html.slices(pa.array([None, big, big + big, "x", None], pa.string()))) == [(0, 2), (2, 1), (3, 2)]
    assert html.parse_html.__wrapped__(pa.array([], pa.string())).to_pylist() == []


def test_elements_of_slices(spark):
    pages = spark.createDataFrame([(i, PAGE if i % 3 else None) for i in range(300)], "page_id long, html string")
    got = {(r.page_id, r.pos, r.end, r.tag, tuple(sorted(r.attrs.items())), r.text_join) for r in html.elements(pages.coalesce(1)).collect()}
    assert got == {(i, e["pos"], e["end"], e["tag"], tuple(sorted(e["attrs"])), e["text_join"]) for i in range(300) if i % 3 for e in html.element_rows(PAGE)}


def test_links_are_parsed_and_resolved_once(spark):
    pages = spark.createDataFrame([("https://e.com/a", PAGE)], "url string, html string")
    for df in (frontier.page_edges(pages, follow_all=True), engine.html_functions.page_links(pages, "url")):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1


def test_csv_files_are_read_by_name(spark, tmp_path):
    links = [("https://a", None, None, None), ("https://b", 1, 'say "x", y', "/2"), ("https://b", 0, "", "/1"), ("https://b", 2, "Title", "URL")]
    df = spark.createDataFrame(links, "careers_url string, pos int, title string, url string")
    path = f"file://{tmp_path}/csv"
    for _ in range(2):  # the second time replaces the first
        files = store.write_links_csv(df, path)
    assert sorted(f.relative_to(tmp_path / "csv").name for f in (tmp_path / "csv").rglob("*") if f.is_file()) == ["part-00000.csv"] * 2
    got = sorted((r.heads, r.title or "", r.url or "") for r in store.read_links_csv(files).collect())
    assert got == [(1, "", ""), (1, "", "/1"), (1, "Title", "URL"), (1, 'say "x", y', "/2")]
