"""Text functions: chunks, fingerprints, ids, prompts, markdown, error kinds."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .html import SILENT, VOID, Document
from .vectorized import arrow


def fingerprint(html: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text."""
    return F.sha2(html.cast("binary"), 256)


def chunks(df: DataFrame, text: str, key: str, size: int = 100_000, overlap: int = 1_000, max_chunks: int = 8, lossy_tail: bool = True) -> DataFrame:
    """(key, chunk_idx, start, chunk): chunk k >= 1 begins ``overlap`` before k * size; every chunk has at most ``size`` characters.

    With ``lossy_tail`` the text beyond the last chunk's end is not covered (nor beyond ``max_chunks``); without it the last
    chunk runs to the end of the text.
    """
    n = F.length(text)
    starts = F.transform(F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size)), 1, max_chunks), lambda x: F.when(x > 0, x - overlap).otherwise(x))
    rows = df.where(F.length(text) > 0).select(key, F.col(text).alias("_t"), F.size(starts).alias("_k"), F.posexplode(starts).alias("chunk_idx", "_s"))
    length = F.lit(size) if lossy_tail else F.when(F.col("chunk_idx") == F.col("_k") - 1, F.length("_t")).otherwise(F.lit(size))
    return rows.select(key, "chunk_idx", F.col("_s").cast("long").alias("start"), F.substring(F.col("_t"), F.col("_s") + 1, length).alias("chunk"))


def is_rate_limit(message: Column) -> Column:
    m = F.lower(message)
    return F.coalesce(m.contains("429") | m.contains("resource exhausted") | (m.contains("rate") & m.contains("limit")), F.lit(False))


LISTING_TASK = (
    "Decide whether this part of a web page lists several open positions. Answer with one JSON object: is_job_listing, score (0 to 10), "
    "has_pagination, next_page_element (text, href, selector) or null, parent_container_selector, child_job_link_selector (one selector, no comma), "
    "individual_job_links (list of href, text, selector). Use CSS selectors that occur in the markup.\n\nMarkup:\n"
)
DETAIL_TASK = (
    "Describe the position on this page. Answer with one JSON object of strings: jobtitle, location, required_skills, compensation, salary (or null), "
    "benefits. Leave a field empty if the page does not state it.\n\nPage:\n"
)


def listing_prompt(chunk: Column) -> Column:
    return F.concat(F.lit(LISTING_TASK), chunk)


def detail_prompt(markdown: Column) -> Column:
    return F.concat(F.lit(DETAIL_TASK), markdown)


def repair_prompt(error: str, attempt: int) -> str:
    return f"Attempt {attempt + 1} was not usable: {error}. Send the corrected JSON object alone."


def job_id(seed: Column, normalized_job_url: Column) -> Column:
    """The jobs table's id."""
    return F.sha2(F.concat(F.coalesce(seed, F.lit("")), F.coalesce(normalized_job_url, F.lit(""))).cast("binary"), 256)


_BLOCKS = frozenset("p li h1 h2 h3 h4 h5 h6 td th pre blockquote dt dd".split())


def to_markdown(html: str | None, min_words: int = 5, threshold: float = 0.2) -> str:
    """Pruned markdown: blocks of ``min_words`` or more whose text is not mostly links. An approximation of DOM pruning by text density."""
    document = Document(html or "")
    skip, out = -1, []
    for node in document.nodes:
        if node.pos <= skip:
            continue
        if node.tag in SILENT or node.tag in ("nav", "footer", "header", "aside", "style") or node.tag in VOID:
            skip = node.end
            continue
        if node.tag not in _BLOCKS or any(n.tag in _BLOCKS for n in document.nodes[node.pos + 1 : node.end + 1]):
            continue
        text = " ".join(" ".join(document.texts(node)).split())
        linked = sum(len(" ".join(document.texts(n))) for n in document.nodes[node.pos + 1 : node.end + 1] if n.tag == "a")
        heading = re.fullmatch(r"h([1-6])", node.tag)
        if not text or (not heading and len(text.split()) < min_words) or 1 - linked / len(text) < threshold:
            continue
        out.append(("#" * int(heading[1]) + " " if heading else "- " if node.tag == "li" else "") + text)
    return "\n\n".join(out)


@arrow("string")
def markdown(html: pa.Array) -> pa.Array:
    return pa.array([to_markdown(x.as_py()) for x in html], pa.string())
