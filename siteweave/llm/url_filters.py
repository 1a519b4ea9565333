"""URL filters with redirect equivalence: rules per host and path, and block decisions that reach all aliases.

A url's own longest rule decides first. A url without a rule takes its class's decision: aliases are joined by
redirect and canonical-link edges (a given redirect table, canonical links and refresh targets in the page, and
spellings of one address), components are computed distributedly, and a component with a blocked member is
blocked, unless it also has an explicitly allowed member: explicit allow has precedence. The rest is allowed.
Members are all ends of edges, whether or not they are rows of pages.

Edges of a page are its canonical links and refresh targets, all of them: read from whole tags (so neither from comments,
scripts and styles nor from other attributes' values), with character references decoded, and resolved by RFC 3986 against
the page's url or its ``base`` tag. Targets without ``://`` after that (mail addresses, scripts) are no edges.

DataFrame functions only. Defined results: a null url, or one without ``://``, has empty host and path, no rule,
no aliases and is allowed; repeated rows are judged each; a null html has no edges; urls and pages of any length are read
whole; extra columns pass through (a computed column replaces one of its name); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, small_side
from .graph import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query keys that don't change what a url shows.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
#: What holds no tags: comments, and elements whose content is text.
SKIPPED = r"(?is)<!--(?:>|->|.*?(?:--!?>|\z))|<(?:script\b.*?</script|style\b.*?</style|textarea\b.*?</textarea|title\b.*?</title)\b[^>]*>"
TAG = r"""(?is)<[a-z][^\s/>]*+(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+>"""
#: Name, then the value as one of three groups.
ATTRIBUTE = r"""([^\s"'<>/=][^\s>/=]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))"""
REFERENCE = r"&(?:#[xX][0-9a-fA-F]{1,8}|#[0-9]{1,9}|amp|lt|gt|quot|apos);"
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
#: Up to this many rules are one expression; longer lists are joined on host suffixes.
COMPILED_RULES = 256


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """One spelling for an address: host without ``www.``, path without end slash, query without tracking keys, no fragment."""

    def key(url: Column) -> Column:
        host = F.regexp_replace(host_of(url), r"^www\.", "")
        query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
        args = F.array_join(F.filter(F.split(query, "&"), lambda a: (a != "") & ~a.rlike(TRACKING)), "&")
        path = F.regexp_replace(path_of(url), r"/+$", "")
        return F.when(F.instr(url, "://") > 0, F.concat(host, path, let(args, lambda x: F.when(x != "", F.concat(F.lit("?"), x)).otherwise(F.lit("")))))

    return let(url, key)


def _undotted(path: Column) -> Column:
    """The path without its ``.`` and ``..`` segments."""

    def put(done: Column, part: Column) -> Column:
        return F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part)))

    def short(path: Column) -> Column:
        kept = F.aggregate(F.split(F.substring(path, 2, 1 << 30), "/"), F.array().cast("array<string>"), put)
        ended = lambda x: F.concat(F.lit("/"), F.array_join(x, "/"), F.when(path.rlike(r"/\.\.?$") & (F.size(x) > 0), F.lit("/")).otherwise(F.lit("")))
        return F.when(path.rlike(r"/\.\.?(/|$)"), let(kept, ended)).otherwise(path)

    return let(path, short)


def resolve(base: Column, target: Column) -> Column:
    """Absolute form of a reference by RFC 3986, without its fragment; ``base`` is absolute, with ``://``."""
    part = lambda text, pattern, i=1: F.regexp_extract(text, pattern, i)

    def joined(x: Column) -> Column:
        base, ref = x["base"], x["ref"]
        root, path = part(base, r"^([^:/?#]+://[^/?#]*)"), path_of(base)
        absolute = lambda whole: F.concat(part(whole, r"^[^:/?#]+://[^/?#]*", 0), _undotted(path_of(whole)), part(whole, r"\?.*$", 0))
        folder = F.coalesce(F.nullif(part(path, r"^(.*/)"), F.lit("")), F.lit("/"))
        return (
            F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:(?!//)"), F.lit(None))
            .when(ref.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"), let(F.when(ref.startswith("//"), F.concat(part(base, r"^([^:/?#]+:)//"), ref)).otherwise(ref), absolute))
            .when(ref == "", part(base, "^[^#]*", 0))
            .when(ref.startswith("?"), F.concat(root, path, ref))
            .otherwise(F.concat(root, _undotted(F.concat(F.when(ref.startswith("/"), F.lit("")).otherwise(folder), part(ref, "^[^?]*", 0))), part(ref, r"\?.*$", 0)))
        )

    return let(F.struct(base.alias("base"), F.regexp_replace(target, "#.*$", "").alias("ref")), joined)


def _decoded(value: Column) -> Column:
    """The text with its character references read, each once, and without the white space that urls don't keep."""

    def one(reference: Column) -> Column:
        name = F.substring(reference, 2, 1 << 30)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.regexp_extract(name, "[0-9a-fA-F]+", 0), 16, 10)).otherwise(F.regexp_extract(name, "[0-9]+", 0)).cast("long")
        number = F.when((number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF), number).otherwise(F.lit(0xFFFD))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        for word, stands_for in NAMED.items():
            char = F.when(name == f"{word};", F.lit(stands_for)).otherwise(char)
        return char

    def read(value: Column) -> Column:
        chars = F.transform(F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0)), one)
        pieces = F.zip_with(F.split(value, REFERENCE), chars, lambda text, char: F.concat(text, F.coalesce(char, F.lit(""))))
        return F.when(value.contains("&"), F.array_join(pieces, "")).otherwise(value)

    return F.regexp_replace(let(value, read), r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\r\n]", "")


def _attribute(tag: Column, name: str) -> Column:
    """The decoded value of the tag's first attribute of this name, or null."""
    found = F.get(F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), lambda a: a.rlike(rf"(?i)^{name}\s*=")), F.lit(0))
    return _decoded(let(found, lambda a: F.concat(*(F.regexp_extract(a, ATTRIBUTE, i) for i in (2, 3, 4)))))


def _refresh(content: Column) -> Column:
    """The url in the content of a refresh: seconds, a mark, ``url=`` and the url, which may be quoted."""
    def url(x: Column) -> Column:
        quoted = F.regexp_extract(x, r"""(?s)^["']([^"']*)""", 1)
        return F.trim(F.when(x.rlike("""^["']"""), quoted).otherwise(x))

    def read(content: Column) -> Column:
        rest = F.regexp_extract(content, r"(?is)^\s*[\d.]*\s*[;,]?\s*(.*)$", 1)
        timed = content.rlike(r"(?i)^\s*[\d.]+\s*[;,\s]")
        return let(rest, lambda x: F.when(timed | x.rlike(r"(?i)^url\s*="), let(F.regexp_replace(x, r"(?i)^url\s*=\s*", ""), url)))

    return let(content, read)


def page_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): every canonical link and refresh target of a page."""
    marked = pages.where("instr(url, '://') > 0 and (html ilike '%canonical%' or html ilike '%refresh%')")
    tags = F.regexp_extract_all(F.regexp_replace("html", SKIPPED, " "), F.lit(TAG), F.lit(0))
    tagged = marked.select("url", F.filter(tags, lambda t: t.rlike(r"(?i)^<(link|meta|base)[\s/]")).alias("tags"))

    def target(tag: Column) -> Column:
        canonical = tag.rlike("(?i)^<link") & _attribute(tag, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
        refresh = tag.rlike("(?i)^<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh")
        return F.when(canonical, _attribute(tag, "href")).when(refresh, _refresh(_attribute(tag, "content")))

    given = lambda values: F.filter(values, lambda x: x.isNotNull() & (x != ""))
    base = F.get(given(F.transform(F.filter("tags", lambda t: t.rlike("(?i)^<base")), lambda t: _attribute(t, "href"))), F.lit(0))
    # a table of few and narrow rows, so that no later filter repeats the parsing
    read = materialize(tagged.select("url", base.alias("base"), F.explode(given(F.transform("tags", target))).alias("target")), "page-links")
    stands = F.coalesce(resolve(F.col("url"), F.col("base")), F.col("url"))
    return read.select(F.col("url").alias("from_url"), resolve(stands, F.col("target")).alias("to_url"))


def _parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


def match_rules(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule whose host covers ``host`` and whose path starts ``path``."""
    if len(rules) <= COMPILED_RULES:
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for action, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
            host, path = _parts(text)
            fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
            rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
        return df.withColumns({"rule": rule, "rule_verdict": verdict})
    spark = df.sparkSession
    listed = materialize(spark.createDataFrame([(*_parts(t), t, a) for a, t in rules], "r_host string, r_path string, r_rule string, r_action string"), "rules")
    sites = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = sites.withColumn("r_host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    best = (
        suffixes.join(small_side(listed), "r_host")
        .where(F.col("path").startswith(F.col("r_path")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("r_rule").alias("n"), (F.col("r_action") == "allow").alias("a"), "r_rule", "r_action")).alias("best"))
    )
    return df.join(best, ["host", "path"], "left").withColumns({"rule": F.col("best.r_rule"), "rule_verdict": F.col("best.r_action")}).drop("best")


def judge(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule, verdict, component to each row of ``pages`` (needs ``url``; ``html`` is used for edges).

    ``redirects`` may hold (from_url, to_url). The page bodies are scanned once for edges and never shuffled.
    """
    links = page_links(pages) if "html" in pages.columns else None
    if redirects is not None:
        given = redirects.select("from_url", "to_url")
        links = given if links is None else links.unionByName(given)
    df = pages.drop("html").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "_key": alias_key(F.col("url"))})
    df = match_rules(df, rules)
    ballots = df.select("_key", "rule_verdict")
    if links is None:
        edges = df.select(F.col("_key").alias("a"), F.col("_key").alias("b")).limit(0)
    else:
        keyed = links.withColumns({"a": alias_key(F.col("from_url")), "b": alias_key(F.col("to_url"))}).where("a is not null and b is not null")
        edges = materialize(keyed, "url-links")
        ends = edges.select(F.explode(F.array("from_url", "to_url")).alias("url"))
        ends = ends.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), alias_key(F.col("url")).alias("_key"))
        ballots = ballots.unionByName(match_rules(ends, rules).select("_key", "rule_verdict"))
    votes = ballots.where("_key is not null").groupBy("_key").agg(F.max(F.col("rule_verdict") == "block").alias("blocked"), F.max(F.col("rule_verdict") == "allow").alias("allowed"))
    comps = materialize(connected_components(edges, "a", "b"), "url-components")
    joined = votes.join(comps.withColumnRenamed("node", "_key"), "_key", "left").withColumn("component", F.coalesce("component", "_key"))
    decided = joined.groupBy("component").agg(F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
    shut = materialize(decided.where("blocked and not coalesce(allowed, false)").select(F.col("component").alias("_shut")), "blocked")
    out = df.join(comps.withColumnRenamed("node", "_key"), "_key", "left").withColumn("component", F.coalesce("component", "_key"))
    out = out.join(small_side(shut, 200_000), F.col("component") == F.col("_shut"), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("_shut").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumn("verdict", verdict).drop("_key", "_shut", "rule_verdict")
