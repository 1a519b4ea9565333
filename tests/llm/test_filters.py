import random

from pyspark.sql import functions as F

from siteweave.llm import graph, line_dedup, quality_rules, url_filters
from siteweave.llm.queries import URL_RULES


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + i) for i in range(80)] + [(7, 7), (None, 3)]
    parent = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.connected_components(df, "a", "b").collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert graph.connected_components(df.limit(0), "a", "b").count() == 0


def test_url_verdicts(spark):
    link = '<link href="{}" rel="canonical">'.format
    rows = [
        (1, "http://a.net/es/x", None), (2, "http://b.org/y", link("http://a.net/es/x/")), (3, "https://www.b.org/y/?utm_source=q#z", None),
        (4, "http://c.org/", '<meta http-equiv="refresh" content="0; url=/moved">'), (5, "http://c.org/moved", link("//b.org/y")), (6, "http://d.org/", ""),
        (7, "http://x.com/", link("http://n.net/fr/1")), (8, "http://n.net/fr/1", None), (9, "http://e.org/", link("http://x.com/")), (10, None, None), (11, "no url", None),
        (12, "HTTP://WWW.Example.COM/en/a", None), (13, "http://m.example.com/en/b", None), (14, "http://example.com", None), (14, "http://example.com", None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(df, URL_RULES).collect()}
    assert {k: v[3] for k, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow", 11: "allow", 12: "allow", 13: "block", 14: "allow"}
    assert got[10] == ("", "", None, "allow") and got[12] == ("www.example.com", "/en/a", "www.example.com/en/", "allow") and got[14][2] is None
    assert url_filters.judge(df.limit(0), URL_RULES).count() == 0


def test_long_rule_lists_agree(spark):
    df = spark.createDataFrame([(i, f"http://{'s.' * (i % 3)}h{i % 20}.com/p{i % 4}/q") for i in range(200)], "page_id long, url string")
    rules = [("block" if i % 3 else "allow", f"h{i % 20}.com/{'p1/' if i % 2 else ''}") for i in range(60)]
    rules = list(dict.fromkeys(rules))
    short = {r.page_id: r.verdict for r in url_filters.judge(df, rules).collect()}
    many = rules + [("block", f"other{i}.net/") for i in range(300)]
    assert {r.page_id: r.verdict for r in url_filters.judge(df, many).collect()} == short


def test_redirect_table(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (2, "http://x.net/es/")], "page_id long, url string")
    moved = spark.createDataFrame([("http://a.org/", "http://x.net/es/"), (None, "http://a.org")], "from_url string, to_url string")
    assert {r.page_id: r.verdict for r in url_filters.judge(df, URL_RULES, moved).collect()} == {1: "block", 2: "block"}


def test_edge_ends_that_are_no_pages(spark):
    link = '<link href="{}" rel="canonical">'.format
    rows = [
        (1, "http://b.org/y", link("http://a.net/es/x")), (2, "http://c.org/", '<meta http-equiv="refresh" content="0; url=http://n.net/fr/1">'), (3, "http://c.org", None),
        (4, "http://d.org/", link("http://n.net/fr/2")), (5, "http://e.org/", link("http://d.org/")), (6, "http://f.org/", link("http://shop.com/")),
        (7, "http://g.org/", None), (8, "http://h.org/", None), (9, "no url", link("http://a.net/es/z")), (10, "http://net/es/", link("http://www.example.com/en/q")), (11, "http://i.org/", None),
        (12, "http://j.org/", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    moved = [("http://g.org/", "http://a.net/es/r"), ("http://x.net/fr/old", "http://h.org/"), ("http://f.org", "http://n.net/es/f"), ("http://d.org/", "http://www.x.com/"), (None, "http://a.net/es/i"), ("http://j.org", None)]
    moved = spark.createDataFrame(moved, "from_url string, to_url string")
    want = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "block", 11: "allow", 12: "allow"}
    many = [*URL_RULES, *(("block", f"other{i}.info/") for i in range(300))]
    for rules in (URL_RULES, many):
        out = url_filters.judge(df, rules, moved)
        assert {r.page_id: r.verdict for r in out.collect()} == want and out.count() == len(rows)
    alone = {r.page_id: r.verdict for r in url_filters.judge(df, URL_RULES).collect()}
    assert alone[1] == alone[2] == alone[3] == alone[4] == alone[5] == "block" and alone[6] == alone[7] == alone[8] == "allow"


def brute_repeats(words: list[str]) -> int:
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)})


def test_base_counts(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a b c d e a b c d e", "é# b$\nx\nx\n\n\nx", "a a a a a a a", "word " * 3000] + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    for r in quality_rules.score(df).collect():
        t = texts[r.doc_id] or ""
        words = t.split()
        lines = [x for x in t.split("\n") if x.split()]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), brute_repeats(words) if len(words) < 500 else len(words))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id


def test_fences_reject_outliers_alone(spark):
    rng = random.Random(5)
    plain = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(40))
    rows = [(i, plain(), ["en", None][i % 2], ["s", "rare"][i % 40 == 0]) for i in range(400)]
    rows += [(1000, " ".join(f"{w}###" for w in plain().split()), "en", "s"), (1001, plain().upper(), "en", "s"), (1002, " ".join(w * 4 for w in plain().split()), None, "new"), (1003, None, "en", "s")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, kept int")
    out = {r.doc_id: r.kept for r in quality_rules.adaptive_filter(df, carry=("doc_id",)).collect()}
    assert sorted(k for k, kept in out.items() if not kept) == [1000, 1001, 1002, 1003] and len(out) == 404
    whole = quality_rules.adaptive_filter(df, carry=("doc_id", "text")).where("kept")
    assert whole.count() == 400 and "text" in whole.columns
    assert quality_rules.adaptive_filter(df.limit(0), carry=("doc_id",)).count() == 0


def test_spread_sets_the_fences(spark):
    """Two sources of like counts: the one of wider spread has the higher upper and the lower lower fence in every rule."""
    rng = random.Random(6)

    def text(n: int, most: int) -> str:
        words = ["".join(rng.choice("abcdefgh") for _ in range(max(1, 5 + rng.randint(-most, most)))) for _ in range(n)]
        for i in rng.sample(range(n), rng.randint(0, most) * n // 60):
            words[i] = rng.choice([words[i].capitalize(), f"{words[i]}."])
        return " ".join(words)

    rows = [(i, text(200, 1), "en", "narrow") for i in range(120)] + [(200 + i, text(rng.choice([30, 60, 200]), 4), "en", "wide") for i in range(120)]
    rows += [(500 + i, text(100, 1), "en", "few") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limits = {r.t_source: r for r in quality_rules.thresholds(quality_rules.sketches(quality_rules.score(df))).collect()}
    for name, rule in quality_rules.RULES.items():
        hi = lambda s: limits[s][f"t_{name}_hi"]
        assert hi("wide") > hi("narrow") and hi("few") not in (hi("wide"), hi("narrow")), name  # the few rows take the fences of the language
        if rule.both:
            assert limits["wide"][f"t_{name}_lo"] < limits["narrow"][f"t_{name}_lo"], name
    # one document, judged by each source: as many capitals as are odd in the narrow one, and symbols that are odd in both
    words = text(120, 0).lower().replace(".", "").split()
    beyond = next(k for k in range(1, 120) if (k - 2 * k**0.5) / sum(map(len, words)) > 1.1 * limits["narrow"].t_capitals_hi)
    loud = " ".join(w.capitalize() if i < beyond else w for i, w in enumerate(words))
    odd = " ".join(f"{w}$" if i % 4 == 1 else w for i, w in enumerate(words))
    short = " ".join([*words[:10], "$ $"])
    both = [(1000, loud, "en", "narrow"), (1001, loud, "en", "wide"), (1002, odd, "en", "narrow"), (1003, odd, "en", "wide"), (1004, short, "en", "wide")]
    judged = {r.doc_id: r.kept for r in quality_rules.adaptive_filter(df.union(spark.createDataFrame(both, df.schema)), carry=("doc_id",)).collect()}
    assert [k for k, kept in judged.items() if not kept and k < 1000] == [] and {k: v for k, v in judged.items() if k >= 1000} == {1000: False, 1001: True, 1002: False, 1003: False, 1004: True}


def brute_dedup(rows):
    texts = sorted({(k, t) for k, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = {}, {}
    for k, t in texts:
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if not any(x.split() for x in w):
                continue
            if w in seen:
                gone.setdefault((k, t), set()).update((i, i + 1, i + 2))
            seen.setdefault(w, (k, i))
    return {(k, t): (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get((k, t), ()))) for k, t in rows}


def test_line_dedup(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice(["a", "b", "", "c d"]) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "x\ny"), (503, "p\nq\nr"), (503, "p\nq\nr"), (504, "0\np\nq\nr\ns"), (None, "n1\nn2\nn3"), (505, "n1\nn2\nn3\n"), (506, "\n\n\n\n"), (507, "\n".join(str(i) for i in range(30_000)))]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, pos string")
    want = brute_dedup(rows)
    out = line_dedup.remove_repeats(df).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out)) == sorted((k is None, k or 0, want[k, t] or "") for k, t in rows)
    assert all(r.pos == "x" for r in out) and {r.doc_id: r.n_removed for r in out}[504] == 3
    assert line_dedup.remove_repeats(df.limit(0)).count() == 0


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", 5, "en", "s")], "doc_id long, text string, n_lines int, lang string, source string")
    assert line_dedup.remove_repeats(df).first().n_lines == 3
    own = ("_spots", "_kept", "_key", "_mark", "_row", "_id", "_text", "_own_mark", "a", "b", "pos", "w", "first", "n")
    rows = [(i, "a\nb\nc", *own) for i in (1, 2)]
    wide = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in own))
    out = {r.doc_id: tuple(r) for r in line_dedup.remove_repeats(wide).collect()}
    assert out == {1: (1, "a\nb\nc", *own, 3, 0), 2: (2, "", *own, 3, 3)}
    assert quality_rules.score(df.withColumn("base_failed", F.lit("?"))).first().base_failed is True


def linked_pages(seed: int) -> list[tuple[int, str, str]]:
    """Pages whose canonical and refresh tags make chains, cycles and hubs, written in many ways."""
    rng = random.Random(seed)
    hosts = ["a.org", "www.b.org", "shop.com", "x.net", "www.example.com", "example.com", "c.info"]
    paths = ["/", "/en/a", "/es/b", "/fr/c/d.html", "/p/q/r", "/p/q/", "", "/z?x=1", "/z?utm_source=u&x=1", "/z?x=1&ref=2#top"]
    here = [f"{rng.choice(['http', 'https', 'HTTP'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(60)] + [f"http://chain{i}.org/{i}" for i in range(30)]
    targets = [*here, "http://c.info/p/../p/./q", "//x.net/es/q", "/en/a", "../f", "./g/../h", "?v=2", "?a=1&amp;b=2", "r", "#part", "", "mailto:a@b.c", "javascript:void(0)", "/go?u=http://n.net/es/", "h&#116;tp://x.net/es&#x2F;", "http://n.net/fr/none", "http://b.org"]
    rows = []
    for i, url in enumerate(here):
        parts = ["<html><head>"]
        if rng.random() < 0.15:
            parts.append(rng.choice(['<base href="/sub/dir/">', "<BASE target=_top href='http://b.org/k/'>", '<base href="">']))
        if i > 60 and i % 10:
            parts.append(f'<link rel="canonical" href="http://chain{i - 61}.org/{i - 61}">')
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            to = rng.choice(targets).replace('"', "")
            parts.append(rng.choice([
                f'<link rel="canonical" href="{to}">', f"<LINK href='{to}' class=x REL='alternate  Canonical'/>", f'<link data-href="http://x.net/es/" rel=canonical href = "{to}" >',
                f'<meta http-equiv="refresh" content="0; url={to}">', f"<meta content=\"5;URL='{to}'\" HTTP-EQUIV=Refresh>", f'<!-- <link rel="canonical" href="{to}"> -->',
                f'<script>x = \'<link rel="canonical" href="{to}">\'</script>', f'<p title=\'<link rel="canonical" href="{to}">\'>canonical</p>', f'<link rel="stylesheet" href="{to}">', f'<link rel="canonicals" href="{to}">',
            ]))
        rows.append((i, url, "".join(parts)))
    for i in range(100, 140):
        to = rng.choice([f"http://solo{i - 1}.info/", f"http://n{i}.net/es/", f"/{i}", f"http://m{i}.com/?a=1&amp;b", f"//solo{i - 2}.info/#x"])
        rows.append((i, f"http://solo{i}.info/", f'<link rel="canonical" href="{to}">'))
    return rows + [(900, None, "canonical"), (901, "plain", '<link rel="canonical" href="http://x.net/es/">'), (902, here[0], None), (903, "http://x.net/es/", ""), (903, "http://x.net/es/", "")]


def brute_links(url: str, html: str) -> list[str]:
    """Targets by the standard library's parser and join."""
    from html.parser import HTMLParser
    from urllib.parse import urljoin

    found, base = [], []

    class Reader(HTMLParser):
        def handle_starttag(self, tag, attrs):
            at = {}
            for k, v in attrs:
                at.setdefault(k, (v or "").strip())
            if tag == "base" and at.get("href"):
                base.append(at["href"])
            if tag == "link" and "canonical" in at.get("rel", "").lower().split() and at.get("href"):
                found.append(at["href"])
            if tag == "meta" and at.get("http-equiv", "").lower() == "refresh":
                to = at.get("content", "").partition(";")[2].strip()[4:].strip("'")
                if to:
                    found.append(to)

    def undotted(url: str) -> str:
        """The library's join leaves the dots of absolute addresses."""
        front, _, rest = url.partition("://")
        host, slash, path = rest.partition("/")
        return f"{front}://{host}{urljoin('http://h/', slash + path).removeprefix('http://h')}" if slash else url

    Reader().feed(html)
    start = undotted(urljoin(url, base[0])) if base else url
    return [undotted(x) for x in (urljoin(start, t).partition("#")[0] for t in found) if "://" in x.partition("?")[0]]


def brute_key(url: str) -> str:
    rest = url.partition("://")[2].partition("#")[0]
    place, _, query = rest.partition("?")
    host, slash, path = place.partition("/")
    args = [a for a in query.split("&") if a and not (a.partition("=")[0] in ("ref", "fbclid", "gclid") or a.startswith("utm_"))]
    return host.lower().removeprefix("www.") + (slash + path).rstrip("/") + ("?" + "&".join(args) if args else "")


def brute_rule(url: str) -> tuple[str, str] | None:
    host, slash, path = url.partition("://")[2].partition("#")[0].partition("?")[0].partition("/")
    fits = [(r, a) for a, r in URL_RULES if (f".{host.lower()}").endswith(f".{r.partition('/')[0]}") and (slash + path).startswith("/" + r.partition("/")[2])]
    return max(fits, key=lambda x: len(x[0])) if fits else None


def brute_verdicts(rows) -> dict:
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    ends = set()
    for _, url, html in rows:
        if url and "://" in url:
            ends.add(url)
            for to in brute_links(url, html or ""):
                ends.add(to)
                root[find(brute_key(url))] = find(brute_key(to))
    votes: dict = {}
    for url in ends:
        if hit := brute_rule(url):
            votes.setdefault(find(brute_key(url)), set()).add(hit[1])
    out = {}
    for i, url, _ in rows:
        own = brute_rule(url) if url and "://" in url else None
        group = votes.get(find(brute_key(url)), set()) if url and "://" in url else set()
        out[i] = own[1] if own else "block" if group == {"block"} else "allow"
    return out


def test_links_against_brute_force_and_sql(spark):
    import duckdb
    import pandas as pd

    from siteweave.llm.queries import ORACLES

    changed = 0
    for seed in range(2):
        rows = linked_pages(seed)
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        want: dict = {}
        for _, url, html in rows:
            if url and "://" in url:
                want.setdefault(url, set()).update(brute_links(url, html or ""))
        got: dict = {url: set() for url in want}
        for r in url_filters.page_links(df).where("to_url is not null").collect():
            got[r.from_url].add(r.to_url)
        shown = lambda x: {u: sorted(map(brute_key, ts)) for u, ts in x.items()}
        assert shown(got) == shown(want)
        out = url_filters.judge(df, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
        verdicts = brute_verdicts(rows)
        assert {r.page_id: r.verdict for r in out} == verdicts and len(out) == len(rows)
        changed += sum(r.rule is None and r.verdict == "block" for r in out)
        con = duckdb.connect()
        con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
        sql = con.execute(ORACLES["op1_url_filters"]).fetchall()
        assert sorted(sql, key=repr) == sorted(map(tuple, out), key=repr)
    assert changed > 10
