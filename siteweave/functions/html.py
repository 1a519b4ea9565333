"""HTML as a relation: a page's elements in document order, from one parse per page.

The tree is built on the standard tokenizer: void elements close at once, an end tag closes the nearest open element
of its name, a stray end tag is dropped, nothing else closes implicitly. Strings inside script, style and template
count for no other element's text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ELEMENT
from .urls import normalized
from .vectorized import arrow

# Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template".split())
DROPPED = frozenset("script style img iframe footer header svg noscript".split())
#: Tags whose text the scoring and link rules read; other elements carry none, or nested pages would grow quadratically.
TEXT_TAGS = frozenset("a button form h1 h2 h3 h4 h5 h6 li option p td th title".split())


@dataclass
class Node:
    pos: int
    parent: int
    depth: int
    tag: str
    attrs: dict[str, str]
    first: int  # strings seen before it
    end: int = -1  # last position inside it
    last: int = -1  # strings seen when it closed
    children: list = field(default_factory=list)  # positions and strings, in order


class Document(HTMLParser):
    """Parses on construction; ``nodes`` in pre-order, ``strings`` as (text, heard outside silent tags)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.strings: list[tuple[str, bool]] = []
        self.top: list = []
        self._open: list[Node] = []
        self.feed(html)
        self.close()
        while self._open:
            self._shut()

    def _shut(self) -> None:
        node = self._open.pop()
        node.end, node.last = len(self.nodes) - 1, len(self.strings)

    def handle_starttag(self, tag, attrs):
        above = self._open[-1] if self._open else None
        values: dict[str, str] = {}
        for name, value in attrs:
            values[name] = value or ""
        node = Node(len(self.nodes), above.pos if above else -1, len(self._open), tag, values, len(self.strings))
        (above.children if above else self.top).append(node.pos)
        self.nodes.append(node)
        self._open.append(node)
        if tag in VOID:
            self._shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._shut()

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self._open):
            while self._open[-1].tag != tag:
                self._shut()
            self._shut()

    def handle_data(self, data):
        heard = not any(n.tag in SILENT for n in self._open)
        (self._open[-1].children if self._open else self.top).append(data)
        self.strings.append((data, heard))

    def texts(self, node: Node) -> list[str]:
        """Non-empty stripped strings under a node; a silent tag hears its own."""
        own = node.tag in SILENT
        return [t for s, heard in self.strings[node.first : node.last] if (heard or own) and (t := s.strip())]

    def string(self, node: Node) -> str | None:
        """The text of a node that holds one string and nothing else (or one such node)."""
        if len(node.children) != 1:
            return None
        only = node.children[0]
        return only if isinstance(only, str) else self.string(self.nodes[only])

    def markup(self, children: list, dropped: frozenset[str] = frozenset()) -> str:
        """HTML of nodes and strings, without subtrees of ``dropped`` tags. Iterative, so depth is no limit."""
        out: list[str] = []
        stack: list = list(reversed(children))
        while stack:
            item = stack.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(escape(item, quote=False))
            elif (node := self.nodes[item]).tag not in dropped:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in node.attrs.items())
                out.append(f"<{node.tag}{attrs}{'/' if node.tag in VOID else ''}>")
                if node.tag not in VOID:
                    stack.append((f"</{node.tag}>",))
                    stack.extend(reversed(node.children))
        return "".join(out)


def element_rows(html: str | None, tags: frozenset[str] | None = None, spoken: frozenset[str] = TEXT_TAGS) -> list[dict]:
    """The elements of ``tags`` (by default all); those of ``spoken`` have their text."""
    document = Document(html or "")
    rows = []
    for n in document.nodes:
        if tags is not None and n.tag not in tags:
            continue
        texts = document.texts(n) if n.tag in spoken else None
        rows.append(
            {
                "pos": n.pos,
                "parent": n.parent,
                "end": n.end,
                "depth": n.depth,
                "tag": n.tag,
                "attrs": list(n.attrs.items()),
                "text_join": None if texts is None else "".join(texts),
                "text_space": None if texts is None else " ".join(texts),
                "string": document.string(n) if n.tag == "title" else None,
            }
        )
    return rows


_ELEMENT_TYPE = pa.struct(
    [("pos", pa.int32()), ("parent", pa.int32()), ("end", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text_join", pa.string()), ("text_space", pa.string()), ("string", pa.string())]
)

#: A slice of a batch: at most so many pages, and bytes of html unless one page has more.
SLICE_PAGES, SLICE_BYTES = 64, 1 << 20


def slices(html: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of a batch's slices. A batch may hold 10,000 pages or 64 MB; only a slice's rows are Python objects at once."""
    first, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(html), 0).to_pylist()):
        if i > first and (i - first == SLICE_PAGES or held + n > SLICE_BYTES):
            yield first, i - first
            first, held = i, 0
        held += n
    if first < len(html):
        yield first, len(html) - first


def by_slices(value: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``value`` of each row (html first), made into Arrow slice by slice."""
    parts = [pa.array([value(*(x.as_py() for x in row)) for row in zip(*(c.slice(*s) for c in columns))], kind) for s in slices(columns[0])]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


@arrow(f"array<{ELEMENT}>")
def parse_html(html: pa.Array) -> pa.Array:
    """The elements of a page. One parse; all rules read this column."""
    return by_slices(element_rows, pa.list_(_ELEMENT_TYPE), html)


#: What the scoring rules read: these elements, and the text of some.
_RULED, _RULED_TEXT = frozenset("title h1 h2 h3 nav div ul li a form input select".split()), frozenset("h1 h2 h3 a form".split())


@arrow(f"array<{ELEMENT}>")
def parse_ruled(html: pa.Array) -> pa.Array:
    """The elements of a page that the scoring rules read; the text of paragraphs and items stays behind."""
    return by_slices(lambda x: element_rows(x, _RULED, _RULED_TEXT), pa.list_(_ELEMENT_TYPE), html)


def link_rows(html: str | None, url: str | None) -> list[dict]:
    """The page's a[href] in document order, each with its text and its target: the href normalized against the url."""
    document = Document(html or "")
    found = [(n.attrs["href"], "".join(document.texts(n))) for n in document.nodes if n.tag == "a" and "href" in n.attrs]
    return [{"href": href, "text": text, "target": normalized(href, url)} for href, text in found]


@arrow("array<struct<href:string,text:string,target:string>>")
def parse_links(html: pa.Array, url: pa.Array) -> pa.Array:
    """The links of a page, without its other elements."""
    return by_slices(link_rows, pa.list_(pa.struct([("href", pa.string()), ("text", pa.string()), ("target", pa.string())])), html, url)


def minified(html: str | None) -> str:
    """Inner HTML of the body without scripts, styles, media and page furniture; '' without a body."""
    document = Document(html or "")
    body = next((n for n in document.nodes if n.tag == "body"), None)
    return document.markup(body.children, DROPPED).strip() if body else ""


@arrow("string")
def minify_body(html: pa.Array) -> pa.Array:
    return by_slices(minified, pa.string(), html)


def minify_regular(html: Column) -> Column:
    """Built-in form for regular pages (dropped tags not nested in themselves); a body that is never closed ends with the page."""
    body = F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<body[^>]*>(.*?)(?:</body>|\z)", 1)
    for tag in sorted(DROPPED - {"img"}):
        body = F.regexp_replace(body, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "")
    return F.trim(F.regexp_replace(body, r"(?is)<img\b[^>]*>", ""))


def elements(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The relation (key, pos, parent, end, depth, tag, attrs, text_join, text_space, string)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                keys, html = (c.slice(*s) for c in batch.columns)
                found = pa.array([element_rows(x.as_py()) for x in html], pa.list_(_ELEMENT_TYPE))
                yield pa.RecordBatch.from_arrays([keys.take(found.value_parent_indices()), *found.flatten().flatten()], [key, *(f.name for f in _ELEMENT_TYPE)])

    fields = F.lit(None).cast(ELEMENT)
    schema = pages.select(key, fields.alias("e")).select(key, "e.*").schema
    return pages.select(key, "html").mapInArrow(run, schema)


def descendants(rows: DataFrame, containers: DataFrame, key: str = "page_id") -> DataFrame:
    """Elements below containers of the same page, with the container's position: a range join on pre-order intervals."""
    inside = containers.select(F.col(key).alias("_key"), F.col("pos").alias("container_pos"), F.col("end").alias("_end"))
    return rows.join(inside, (F.col(key) == F.col("_key")) & (F.col("pos") > F.col("container_pos")) & (F.col("pos") <= F.col("_end"))).drop("_key", "_end")


def tagged(rows: Column, *tags: str) -> Column:
    return F.filter(rows, lambda e: e["tag"].isin(*tags))


def links(rows: Column) -> Column:
    """a[href] elements in document order."""
    return F.filter(rows, lambda e: (e["tag"] == "a") & F.map_contains_key(e["attrs"], "href"))


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, source_url, pos, href, text, target): a[href] in document order; ``target`` is normalized, null where that fails."""
    found = pages.select(key, F.col(url).alias("source_url"), F.posexplode(parse_links("html", url)).alias("pos", "e"))
    return found.select(key, "source_url", "pos", "e.*").select(key, "source_url", "pos", "href", "text", "target")


# The regular-page forms below stay in the JVM: pages whose anchors and headings hold no nested tags.
ANCHOR = r"<a href=\"([^\"]*)\">([^<]*)</a>"


def regular_links(html: Column) -> Column:
    """array<struct<pos, href, text>> of plain anchors."""
    hrefs, texts = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1)), F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(2))
    return F.transform(F.arrays_zip(hrefs.alias("href"), texts.alias("text")), lambda x, i: F.struct(i.alias("pos"), x["href"].alias("href"), x["text"].alias("text")))


def regular_text(html: Column, tag: str) -> Column:
    """Lower-cased text of the first element of a tag without nested tags, entities of the basic set decoded."""
    raw = F.regexp_extract(html, rf"(?s)<{tag}>([^<]*)</{tag}>", 1)
    for entity, sign in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(entity), F.lit(sign))
    return F.lower(F.trim(raw))
