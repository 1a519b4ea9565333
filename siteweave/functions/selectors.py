"""CSS selectors: parsing, matching against a parsed page, and link extraction.

Grammar: tag, *, .class, #id, [a], [a=v] and the operators ~= |= ^= $= *=, :first-child, :last-child, :nth-child(n),
:not(simple); combinators descendant, >, +, ~; comma lists. Anything else is a syntax error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urljoin

import pyarrow as pa

from .html import Document, Node
from .vectorized import arrow

_NAME = r"-?(?:[_a-zA-Z]|[^\x00-\x7f]|\\.)(?:[-\w]|[^\x00-\x7f]|\\.)*"
_TOKEN = re.compile(
    rf"""(?P<comma>\s*,\s*)|(?P<comb>\s*[>+~]\s*|\s+)|(?P<id>\#{_NAME})|(?P<class>\.{_NAME})|(?P<tag>{_NAME}|\*)
    |\[\s*(?P<attr>{_NAME})\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>{_NAME}|[\w-]+))\s*(?P<flag>[iI])?\s*)?\]
    |:(?P<pseudo>first-child|last-child|only-child|empty|nth-child\(\s*(?P<nth>\d+|odd|even|\d*n(?:\s*\+\s*\d+)?)\s*\)|not\(\s*(?P<not>(?:[^()]|\([^()]*\))+)\s*\))""",
    re.VERBOSE,
)


class SelectorError(ValueError):
    pass


@dataclass
class Compound:
    tests: list = field(default_factory=list)
    combinator: str = ""  # to the compound on its left


Selector = list[Compound]


@lru_cache(maxsize=4096)
def parse(text: str) -> tuple[Selector, ...]:
    """Alternatives, each a list of compounds from left to right. Raises SelectorError."""
    source, at, out, now, compound, pending = text.strip(), 0, [], [], None, ""
    if not source:
        raise SelectorError("empty selector")

    def close_compound() -> None:
        nonlocal compound
        if compound is None or not compound.tests:
            raise SelectorError(f"nothing to match in {text!r}")
        now.append(compound)
        compound = None

    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m or m.end() == at:
            raise SelectorError(f"cannot read {source[at:]!r}")
        at = m.end()
        if m["comma"] is not None:
            close_compound()
            out.append(now)
            now, pending = [], ""
            continue
        if m["comb"] is not None:
            close_compound()
            pending = m["comb"].strip() or " "
            continue
        if compound is None:
            compound = Compound(combinator=pending)
        if m["tag"] is not None:
            if compound.tests:
                raise SelectorError(f"a tag after other tests in {text!r}")
            compound.tests.append(("tag", m["tag"].lower()))
        elif m["id"]:
            compound.tests.append(("attr", "id", "=", m["id"][1:].replace("\\", ""), False))
        elif m["class"]:
            compound.tests.append(("attr", "class", "~=", m["class"][1:].replace("\\", ""), False))
        elif m["attr"]:
            value = next((m[g] for g in ("dq", "sq", "bare") if m[g] is not None), None)
            compound.tests.append(("attr", m["attr"].lower(), m["op"], value, bool(m["flag"])))
        elif m["not"]:
            compound.tests.append(("not", parse(m["not"])))
        else:
            compound.tests.append(("pseudo", m["pseudo"].partition("(")[0], m["nth"]))
    close_compound()
    out.append(now)
    return tuple(out)


def syntax_error(text: str | None) -> str | None:
    """What is wrong with a selector, or None."""
    try:
        parse(text or "")
    except SelectorError as e:
        return str(e)
    return None


def _siblings(document: Document, node: Node) -> list[int]:
    above = document.nodes[node.parent].children if node.parent >= 0 else document.top
    return [c for c in above if isinstance(c, int)]


def _nth(formula: str, place: int) -> bool:
    if formula in ("odd", "even"):
        return place % 2 == (formula == "odd")
    step, n, offset = formula.partition("n")
    if not n:
        return place == int(step)
    a, b = int(step or 1), int(offset.replace("+", "").strip() or 0)
    return place >= b and (place - b) % a == 0 if a else place == b


def _test(document: Document, node: Node, test: tuple) -> bool:
    if test[0] == "tag":
        return test[1] in ("*", node.tag)
    if test[0] == "not":
        return not any(matches(document, node, s) for s in test[1])
    if test[0] == "attr":
        _, name, op, wanted, fold = test
        if name not in node.attrs:
            return False
        value = node.attrs[name]
        if op is None:
            return True
        if fold:
            value, wanted = value.lower(), wanted.lower()
        return {
            "=": value == wanted,
            "~=": wanted in value.split(),
            "|=": value == wanted or value.startswith(f"{wanted}-"),
            "^=": bool(wanted) and value.startswith(wanted),
            "$=": bool(wanted) and value.endswith(wanted),
            "*=": bool(wanted) and wanted in value,
        }[op]
    kind, formula = test[1], test[2]
    if kind == "empty":
        return not node.children
    among = _siblings(document, node)
    place = among.index(node.pos) + 1
    return {"first-child": place == 1, "last-child": place == len(among), "only-child": len(among) == 1}.get(kind, False) if kind != "nth-child" else _nth(formula, place)


def matches(document: Document, node: Node, selector: Selector, upto: int | None = None) -> bool:
    """Whether the node matches the selector's compounds up to (excluding) ``upto``."""
    upto = len(selector) if upto is None else upto
    compound = selector[upto - 1]
    if not all(_test(document, node, t) for t in compound.tests):
        return False
    if upto == 1:
        return True
    if compound.combinator in (" ", ">"):
        above = node.parent
        while above >= 0:
            if matches(document, document.nodes[above], selector, upto - 1):
                return True
            if compound.combinator == ">":
                return False
            above = document.nodes[above].parent
        return False
    among = _siblings(document, node)
    before = among[: among.index(node.pos)]
    if compound.combinator == "+":
        before = before[-1:]
    return any(matches(document, document.nodes[b], selector, upto - 1) for b in before)


def select(document: Document, text: str, within: Node | None = None) -> list[Node]:
    """Matching nodes in document order, below ``within`` if given (ancestors outside it still count for the match)."""
    alternatives = parse(text)
    nodes = document.nodes if within is None else document.nodes[within.pos + 1 : within.end + 1]
    return [n for n in nodes if any(matches(document, n, s) for s in alternatives)]


def job_links(html: str | None, base: str | None, container: str | None, child: str | None, whole_page: bool) -> list[dict] | None:
    """[{title, url}] of the links that ``child`` selects, first of each url; None if there are none.

    ``whole_page``: the container need only exist, links are looked for everywhere (as a browser session does); else
    below the container's first match. Any error is None.
    """
    if not all((x or "").strip() for x in (html, container, child)):
        return None
    try:
        document = Document(html)
        found = select(document, container)
        if not found:
            return None
        out: dict[str, str] = {}
        for node in select(document, child, None if whole_page else found[0]):
            if href := node.attrs.get("href"):
                out.setdefault(urljoin(base or "", href), "".join(document.texts(node)))
        return [{"title": title, "url": url} for url, title in out.items()] or None
    except ValueError:
        return None


_LINKS = pa.list_(pa.struct([("title", pa.string()), ("url", pa.string())]))
_LINKS_DDL = "array<struct<title:string,url:string>>"


@arrow(_LINKS_DDL)
def static_links(html: pa.Array, base: pa.Array, container: pa.Array, child: pa.Array) -> pa.Array:
    """Links below the container's first match."""
    return pa.array([job_links(*x, False) for x in zip(*(c.to_pylist() for c in (html, base, container, child)), strict=True)], _LINKS)


@arrow(_LINKS_DDL)
def document_links(html: pa.Array, base: pa.Array, container: pa.Array, child: pa.Array) -> pa.Array:
    """Links of the whole page, if the container exists on it."""
    return pa.array([job_links(*x, True) for x in zip(*(c.to_pylist() for c in (html, base, container, child)), strict=True)], _LINKS)


@arrow("string")
def selector_error(selector: pa.Array) -> pa.Array:
    return pa.array([syntax_error(x.as_py()) for x in selector], pa.string())
