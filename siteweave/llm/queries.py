"""One query per training-data operator, with production parameters, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, line_dedup, media, ngram_join, packing, quality_rules, secret_scan, token_files, url_filters, warc
from .common import table
from .tokens import word_tokenizer_path

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filters.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = warc.write(pages)
    wanted = pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("request"))
    records = warc.read(archive, warc.locate(archive, wanted))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(table(spark, sf_dir, "documents"), ngram_join.JoinParams(words=3, percent=90))


def op3_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_links(table(spark, sf_dir, "documents"), ngram_join.JoinParams(words=3, percent=90))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer_path(), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of ``conversations`` under three limits that all bind: answers bear loss, prompts don't."""
    params = packing.PackParams(max_tokens=2048, max_segments=16, max_loss=1024)
    pieces = packing.pack_turns(table(spark, sf_dir, "conversations"), word_tokenizer_path(), 1, params)
    return pieces.select("key.conv_id", "key.turn", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bears")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.adaptive_filter(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_files.write(table(spark, sf_dir, "documents"), word_tokenizer_path(), end_id=2)
    found = token_files.read(store, token_files.locate(store, store.manifest.select("doc_id", "occurrence")))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_media_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.store_texts(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_warc_index": op2_warc_index,
    "op3_ngram_join": op3_ngram_join,
    "op3_ngram_links": op3_ngram_links,
    "op4_packing": op4_packing,
    "op4_packing_turns": op4_packing_turns,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_files": op8_token_files,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_media_ogg": op10_media_ogg,
}

_OP1_SQL = r"""
WITH RECURSIVE tagged AS (
  SELECT page_id, url, list_filter(regexp_extract_all(regexp_replace(html,
      '(?is)<!--(?:>|->|.*?(?:--!?>|\z))|<(?:script\b.*?</script|style\b.*?</style|textarea\b.*?</textarea|title\b.*?</title)\b[^>]*>', ' ', 'g'),
      '(?is)<[a-z][^\s/>]*(?:[^>=]|=\s*(?:"[^"]*"|''[^'']*''|[^\s>"''][^\s>]*)?)*>'), lambda t: regexp_matches(t, '(?i)^<(link|meta|base)[\s/]')) AS ts
  FROM pages WHERE instr(url, '://') > 0 AND (html ILIKE '%canonical%' OR html ILIKE '%refresh%')
), tags AS (
  SELECT row_number() OVER () AS tag, url, p, lower(substr(ts[p], 2, 4)) AS kind, regexp_extract_all(ts[p], '([^\s"''<>/=][^\s>/=]*)\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>][^\s>]*))') AS ats,
    page_id FROM (SELECT page_id, url, ts, unnest(range(1, len(ts) + 1)) AS p FROM tagged)
), raw_values AS (
  SELECT tag, lower(regexp_extract(a, '^[^\s=]+')) AS name, regexp_replace(regexp_replace(a, '^[^\s=]+\s*=\s*', ''), '^["'']|["'']$', '', 'g') AS v, k
  FROM (SELECT tag, ats[k] AS a, k FROM (SELECT tag, ats, unnest(range(1, len(ats) + 1)) AS k FROM tags))
), named AS (
  SELECT tag, name, regexp_replace(array_to_string(list_transform(range(1, len(ps) + 1), lambda i: ps[i] || CASE
      WHEN es[i] IS NULL THEN '' WHEN es[i] = '&amp;' THEN '&' WHEN es[i] = '&lt;' THEN '<' WHEN es[i] = '&gt;' THEN '>' WHEN es[i] = '&quot;' THEN '"' WHEN es[i] = '&apos;' THEN ''''
      WHEN es[i] ILIKE '&#x%' THEN chr(('0x' || regexp_extract(es[i], '[0-9a-fA-F]+'))::INTEGER) ELSE chr(regexp_extract(es[i], '[0-9]+')::INTEGER) END), ''), '^[\x00-\x20]+|[\x00-\x20]+$|[\t\r\n]', '', 'g') AS v
  FROM (SELECT tag, name, string_split_regex(v, '&(?:#[xX][0-9a-fA-F]{1,8}|#[0-9]{1,9}|amp|lt|gt|quot|apos);') AS ps,
    regexp_extract_all(v, '&(?:#[xX][0-9a-fA-F]{1,8}|#[0-9]{1,9}|amp|lt|gt|quot|apos);') AS es FROM raw_values QUALIFY row_number() OVER (PARTITION BY tag, name ORDER BY k) = 1)
), marks AS (
  SELECT t.page_id, t.url, t.p, t.kind, h.v AS href, r.v AS rel, e.v AS equiv, c.v AS content FROM tags t LEFT JOIN named h ON h.tag = t.tag AND h.name = 'href'
    LEFT JOIN named r ON r.tag = t.tag AND r.name = 'rel' LEFT JOIN named e ON e.tag = t.tag AND e.name = 'http-equiv' LEFT JOIN named c ON c.tag = t.tag AND c.name = 'content'
), bases AS (SELECT page_id, url, arg_min(href, p) AS href FROM marks WHERE kind = 'base' AND href <> '' GROUP BY page_id, url
), goals AS (
  SELECT page_id, url, CASE WHEN kind = 'link' AND regexp_matches(rel, '(?i)(^|\s)canonical(\s|$)') THEN href WHEN kind = 'meta' AND lower(equiv) = 'refresh' THEN
    trim(CASE WHEN regexp_matches(content, '(?i)^\s*[\d.]+\s*[;,\s]') OR regexp_matches(regexp_extract(content, '(?is)^\s*[\d.]*\s*[;,]?\s*(.*)$', 1), '(?i)^url\s*=') THEN
      regexp_extract(regexp_replace(regexp_extract(content, '(?is)^\s*[\d.]*\s*[;,]?\s*(.*)$', 1), '(?i)^url\s*=\s*', ''), '(?s)^(?:["'']([^"'']*)|.*)', 0) END, '"'' ') END AS goal FROM marks
), steps AS (
  SELECT page_id, url AS from_url, url AS base, b.href AS ref, g.goal, 0 AS step FROM goals g LEFT JOIN bases b USING (page_id, url) WHERE g.goal <> ''
), refs AS (  -- the base tag's own address first, then the target's, each resolved alike
  SELECT from_url, base, coalesce(regexp_replace(ref, '#.*$', ''), '') AS ref, goal, 0 AS step FROM steps
  UNION ALL
  SELECT from_url, resolved, regexp_replace(goal, '#.*$', ''), goal, step + 1 FROM (
    SELECT *, CASE WHEN starts_with(raw, '!') THEN base ELSE regexp_extract(raw, '^[^:/?#]+://[^/?#]*') || CASE WHEN regexp_matches(pth, '/\.\.?(/|$)') THEN
        '/' || array_to_string(kept, '/') || CASE WHEN regexp_matches(pth, '/\.\.?$') AND len(kept) > 0 THEN '/' ELSE '' END ELSE pth END || regexp_extract(raw, '\?.*$') END AS resolved
    FROM (SELECT *, regexp_extract(raw, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS pth, list_reduce(list_transform(string_split(substr(regexp_extract(raw, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), 2), '/'), lambda x: [x]),
        lambda done, part: CASE WHEN part[1] = '.' THEN done WHEN part[1] = '..' THEN done[:-2] ELSE list_concat(done, part) END, []::VARCHAR[]) AS kept
      FROM (SELECT *, CASE WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:') AND NOT regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN '!'
          WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN ref WHEN starts_with(ref, '//') THEN regexp_extract(base, '^([^:/?#]+)://', 1) || ':' || ref
          WHEN ref = '' THEN regexp_extract(base, '^[^#]*') WHEN starts_with(ref, '?') THEN regexp_extract(base, '^[^?#]*') || ref
          WHEN starts_with(ref, '/') THEN regexp_extract(base, '^[^:/?#]+://[^/?#]*') || ref
          ELSE regexp_extract(base, '^[^:/?#]+://[^/?#]*') || coalesce(nullif(regexp_extract(base, '^[^:/?#]+://[^/?#]*([^?#]*/)', 1), ''), '/') || ref END AS raw FROM refs WHERE step < 2))
  ) WHERE NOT (step = 1 AND starts_with(raw, '!'))
), addresses AS (
  SELECT page_id, url FROM pages UNION ALL SELECT NULL, from_url FROM refs WHERE step = 2 UNION ALL SELECT NULL, base FROM refs WHERE step = 2
), rests AS (
  SELECT page_id, url, instr(coalesce(url, ''), '://') AS pos, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM addresses
), split AS (
  SELECT page_id, url, pos, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), keyed AS (
  SELECT *, CASE WHEN pos > 0 THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda a: a <> '' AND NOT regexp_matches(a, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)')), '&'), ''), '') END AS k FROM split
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM keyed
), decided AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own FROM ruled
), edges AS (
  SELECT DISTINCT a.k AS x, b.k AS y FROM refs r JOIN keyed a ON a.url = r.from_url JOIN keyed b ON b.url = r.base WHERE r.step = 2 AND a.k IS NOT NULL AND b.k IS NOT NULL
), both_ways AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges
), reach AS (SELECT x AS node, x AS to_node FROM both_ways UNION SELECT node, y FROM reach JOIN both_ways ON x = to_node
), homes AS (SELECT node AS k, min(to_node) AS home FROM reach GROUP BY node
), placed AS (SELECT d.*, coalesce(home, k) AS home FROM decided d LEFT JOIN homes USING (k)
), shut AS (SELECT home FROM placed WHERE home IS NOT NULL GROUP BY home HAVING bool_or(own = 'block') AND NOT coalesce(bool_or(own = 'allow'), false))
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN shut.home IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT p.page_id, q.* EXCLUDE (page_id) FROM pages p JOIN (SELECT DISTINCT ON (url) * FROM placed) q ON q.url IS NOT DISTINCT FROM p.url) f LEFT JOIN shut USING (home)
"""

_OP6_SQL = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents
), spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM base WHERE len(w) >= 5
), wins AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 4), ' ') AS g FROM spots
), twice AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1
), reps AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, unnest(range(5)) AS u(o) GROUP BY doc_id
), counts AS (
  SELECT b.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{Lu}')) AS caps, len(regexp_extract_all(t, '[.,;:!?]')) AS marks
  FROM base b LEFT JOIN reps r USING (doc_id)
), judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), long AS (
  SELECT doc_id, lang, source, base_failed, unnest([1, 2, 3, 4, 5, 6]) AS q,
    unnest([word_chars, n_symbols, n_dup_lines, n_repeat_words, caps, marks]) AS x, unnest([n_words, n_words, n_words, n_words, word_chars, n_words]) AS m,
    unnest([1, 1, 1, 5, 1, 1]) AS lump, unnest([true, false, false, false, false, true]) AS both_sides FROM judged
), quarts AS (
  SELECT GROUPING(lang) AS gl, GROUPING(source) AS gs, lang, source, q, count(*) AS n,
    quantile_disc((x + 1) / (m + 1), 0.25) AS a, quantile_disc((x + 1) / (m + 1), 0.75) AS b, quantile_disc(x / m, 0.25) AS c, quantile_disc(x / m, 0.75) AS d
  FROM long WHERE NOT base_failed GROUP BY GROUPING SETS ((lang, source, q), (lang, q), (q))
), fences AS (SELECT *, c - 4.0::DOUBLE * (d - c) AS lo, b + 4.0::DOUBLE * (b - a) AS hi FROM quarts
), chosen AS (
  SELECT g.lang, g.source, g.q, CASE WHEN g.n >= 50 THEN g.lo WHEN l.n >= 50 THEN l.lo ELSE a.lo END AS lo,
    CASE WHEN g.n >= 50 THEN g.hi WHEN l.n >= 50 THEN l.hi ELSE a.hi END AS hi
  FROM fences g JOIN fences l ON l.gl = 0 AND l.gs = 1 AND l.q = g.q AND l.lang IS NOT DISTINCT FROM g.lang
    JOIN fences a ON a.gl = 1 AND a.gs = 1 AND a.q = g.q WHERE g.gl = 0 AND g.gs = 0
), beyond AS (
  SELECT DISTINCT doc_id FROM long r JOIN chosen c ON c.q = r.q AND c.lang IS NOT DISTINCT FROM r.lang AND c.source IS NOT DISTINCT FROM r.source
  WHERE m > 0 AND ((x - 2 * sqrt(lump * x)) / m > hi OR both_sides AND (x + 2 * sqrt(lump * x) + 1) / m < lo)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM beyond) AS kept FROM judged
"""

_OP2_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
firsts AS (SELECT x, h, min(page_id) AS first FROM p GROUP BY x, h),
quints AS (SELECT x, list_transform(range(8), lambda k: ('0x' || substr(x, 5 * k + 1, 5))::BIGINT) AS vs FROM firsts),
named AS (SELECT DISTINCT x, array_to_string(list_transform(range(32), lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((vs[c // 4 + 1] >> (15 - 5 * (c % 4))) & 31)::INTEGER, 1)), '') AS digest FROM quints)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p JOIN firsts USING (x, h) JOIN named USING (x)
"""

_OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM words WHERE len(w) > 0
), grams AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 2), ' ') AS g FROM places
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM grams a JOIN grams b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * i >= 90 * (s.n + t.n - i)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN both_ways ON x = b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""

_OP3_LINKS_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM words WHERE len(w) > 0
), grams AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 2), ' ') AS g FROM places
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM grams a JOIN grams b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * i >= 90 * (s.n + t.n - i)
), reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN links ON x = b
), totals AS (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id) LEFT JOIN totals USING (doc_id)
"""

_OP5_SQL = r"""
WITH lined AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), wins AS (
  SELECT doc_id, p, list_slice(ls, p, p + 2) AS w FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS p FROM lined WHERE len(ls) >= 3)
), placed AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS r FROM wins WHERE regexp_matches(array_to_string(w, ' '), '[^\x20\x09-\x0D]')
), covered AS (
  SELECT DISTINCT doc_id, p + o AS p FROM placed, unnest(range(3)) AS u(o) WHERE r > 1
), gone AS (SELECT doc_id, list(p) AS ps FROM covered GROUP BY doc_id)
SELECT doc_id, CASE WHEN ps IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda l, i: NOT list_contains(ps, i)), chr(10)) END AS text,
  coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(ps), 0)::BIGINT AS n_removed FROM lined LEFT JOIN gone USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_url_filters": _OP1_SQL, "op2_warc_index": _OP2_SQL, "op3_ngram_join": _OP3_SQL, "op3_ngram_links": _OP3_LINKS_SQL, "op5_line_dedup": _OP5_SQL, "op6_quality_rules": _OP6_SQL}
