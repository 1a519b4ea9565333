"""URL functions. Columns in, columns out; Python only for what needs RFC 3986 joining or re-encoding."""

from __future__ import annotations

from urllib.parse import parse_qs, urlencode, urljoin, urlparse, urlunparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectorized import arrow

#: Query keys dropped from normalized urls (case-sensitive).
TRACKING_KEYS = ("utm_source", "utm_medium", "utm_campaign", "ref", "fbclid")
#: Words that mark a link as worth following, as one unanchored pattern; equivalent to the pipeline's list of them.
JOB_LINK_PATTERN = r"(?iud)career|job|position|employment|search|apply|opportunit|vacancies|opening|join.*(?:team|us)"

#: Groups: scheme, network location, path, query.
_PATH = r"^([^:/?#]+)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Absolute http(s) urls whose query needs no re-encoding: plain keys and values, none blank or repeated-looking.
SIMPLE = r"^[hH][tT][tT][pP][sS]?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~!$'()*+,=:@%-]+)*/*(?:\?(?:[A-Za-z0-9_.-]+=[A-Za-z0-9_.-]+)(?:&[A-Za-z0-9_.-]+=[A-Za-z0-9_.-]+)*)?(?:#.*)?$"


def normalized(href: str | None, base: str | None) -> str | None:
    """Joined to the base, host lower-cased, tracking keys and fragment dropped, query re-encoded, end slashes stripped."""
    if not href or href.startswith("#"):
        return None
    try:
        parts = urlparse(urljoin(base or "", href.strip()))
        pairs = {k: v for k, v in parse_qs(parts.query).items() if k not in TRACKING_KEYS}
        return urlunparse((parts.scheme, parts.netloc.lower(), parts.path.rstrip("/") or "/", parts.params, urlencode(pairs, doseq=True), ""))
    except ValueError:
        return None


@arrow("string")
def _normalize_general(href: pa.Array, base: pa.Array) -> pa.Array:
    return pa.array([normalized(h, b) for h, b in zip(href.to_pylist(), base.to_pylist(), strict=True)], pa.string())


@arrow("string")
def _resolve_general(base: pa.Array, href: pa.Array) -> pa.Array:
    def join(b, h):
        try:
            return None if h is None else urljoin(b or "", h)
        except ValueError:
            return None

    return pa.array([join(b, h) for b, h in zip(base.to_pylist(), href.to_pylist(), strict=True)], pa.string())


def normalize_absolute(url: Column) -> Column:
    """Built-in form for urls that match SIMPLE and repeat no query key."""
    part = lambda i: F.regexp_extract(url, _PATH, i)
    pairs = F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING_KEYS))
    path = F.regexp_replace(part(3), "/+$", "")
    query = F.array_join(pairs, "&")
    return F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def is_simple(url: Column) -> Column:
    keys = F.transform(F.split(F.regexp_extract(url, _PATH, 4), "&"), lambda p: F.substring_index(p, "=", 1))
    return url.rlike(SIMPLE) & (F.size(F.array_distinct(keys)) == F.size(keys))


def with_normalized(df: DataFrame, name: str, href: Column, base: Column) -> DataFrame:
    """Adds ``name``, the normalized url. Simple urls never leave the JVM: the others are a branch of their own, so that rows
    are read twice but only those of that branch reach Python. For narrow tables; ``normalize_url`` reads rows once."""
    simple = F.coalesce(is_simple(href), F.lit(False))
    return df.where(simple).withColumn(name, normalize_absolute(href)).unionByName(df.where(~simple).withColumn(name, _normalize_general(href, base)))


def normalize_url(href: Column, base: Column) -> Column:
    """Most absolute urls stay in the JVM; only the others are handed to Python (as nulls otherwise)."""
    simple = F.coalesce(is_simple(href), F.lit(False))
    return F.when(simple, normalize_absolute(href)).otherwise(_normalize_general(F.when(~simple, href), F.when(~simple, base)))


def resolve_url(base: Column, href: Column) -> Column:
    """RFC 3986 join. Root-relative paths without dot segments and absolute urls stay in the JVM."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    rooted = (root != "") & href.rlike(r"^/(?!/)") & ~href.rlike(r"(^|/)\.{1,2}(/|$|[?#])") & ~href.rlike(r"[;\s]") & ~href.rlike(r"[?#]$")
    absolute = href.rlike(r"^https?://[^/?#\s]+/[A-Za-z0-9/_-]*$")
    fast = F.coalesce(rooted | absolute, F.lit(False))
    return F.when(F.coalesce(absolute, F.lit(False)), href).when(fast, F.concat(root, href)).otherwise(_resolve_general(F.when(~fast, base), F.when(~fast, href)))


def url_diff(parent: Column, child: Column) -> Column:
    """The child's path beyond the parent's; null unless the parent's path is a (raw string) prefix; '/' if nothing is left."""
    path = lambda u: F.regexp_extract(u, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    rest = F.regexp_replace(F.substring(path(child), F.length(path(parent)) + 1, F.length(path(child))), "^/+", "")
    return F.when(F.startswith(path(child), path(parent)), F.when(rest == "", "/").otherwise(rest))


def host(url: Column) -> Column:
    """Network location with port and user part as they stand; '_' where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1), F.lit("")), F.lit("_"))


def admissible(href: Column, target: Column, source: Column) -> Column:
    """Whether a link may enter the frontier. ``target`` is normalized; ``source`` is the page's url as fetched.

    Http(s), a dot in the host, no bare fragment, and not the source's own scheme, host and path (queries ignored).
    """
    part = lambda u, i: F.regexp_extract(u, _PATH, i)
    trimmed = F.trim(href)
    own = (part(target, 1) == F.lower(part(source, 1))) & (part(target, 2) == part(source, 2)) & (F.rtrim(part(target, 3), F.lit("/")) == F.rtrim(part(source, 3), F.lit("/")))
    good = (trimmed != "") & ~trimmed.startswith("#") & part(target, 1).isin("http", "https") & part(target, 2).contains(".") & ~own
    return F.coalesce(good, F.lit(False))


def is_job_link(href: Column, text: Column) -> Column:
    """The job-word pattern in the raw href, or else in the anchor's text."""
    return F.coalesce(href.rlike(JOB_LINK_PATTERN), F.lit(False)) | F.coalesce(text.rlike(JOB_LINK_PATTERN), F.lit(False))
