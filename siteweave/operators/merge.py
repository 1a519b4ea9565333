"""Ordered folds as aggregations: chunk answers to one listing, token budgets, sessions, distinct-keep-first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Distinct by ``keys``; of each the first row in ``order`` stays."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return best.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in others))


def distinct_links(links: Column, field: str = "href") -> Column:
    """Of an array of structs, the first of each ``field``, in order; those with a null field go. Two sorts, so n log n."""
    let = lambda value, body: F.transform(F.array(value), body)[0]
    placed = F.transform(F.filter(links, lambda x: x[field].isNotNull()), lambda x, i: F.struct(x[field].alias("k"), i.alias("i"), x.alias("x")))
    firsts = lambda s: F.filter(s, lambda x, j: (j == 0) | (F.get(s, j - 1)["k"] != x["k"]))
    kept = let(F.array_sort(placed), firsts)
    return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["x"].alias("x")))), lambda x: x["x"])


def merge_chunks(responses: DataFrame, careers_url: str | Column = "", key: str = "page_key") -> DataFrame:
    """One listing per page from its chunk answers. Only answers that are listings count.

    any / max / sum / first non-null / first non-empty / last, by chunk order; links concatenate in chunk order and keep
    the first of each href. One shuffle with partial aggregation; a page's answers are few (chunks are capped).
    """
    yes = F.coalesce("is_job_listing", F.lit(False))
    when = lambda value, cond=None: F.when(yes if cond is None else yes & cond, value)
    at = F.col("chunk_idx")
    first = lambda value, cond: F.min_by(value, F.when(yes & cond, at))
    paged = F.coalesce("has_pagination", F.lit(False))
    out = responses.groupBy(key).agg(
        F.coalesce(F.bool_or("is_job_listing"), F.lit(False)).alias("is_job_listing"),
        F.greatest(F.lit(0.0), F.coalesce(F.max(when(F.col("score"))), F.lit(0.0))).alias("score"),
        F.coalesce(F.bool_or(when(F.col("has_pagination"))), F.lit(False)).alias("has_pagination"),
        F.coalesce(first(F.col("parent_container_selector"), F.coalesce("parent_container_selector", F.lit("")) != ""), F.lit("")).alias("parent_container_selector"),
        first(F.col("next_page_element"), paged & F.col("next_page_element").isNotNull()).alias("next_page_element"),
        F.array_sort(F.collect_list(when(F.struct(at.alias("i"), F.coalesce("individual_job_links", F.array()).alias("l"))))).alias("_links"),
        F.max_by(F.struct("child_job_link_selector"), F.when(yes, at)).alias("_child"),
        F.coalesce(F.sum(when(F.col("total_token_count"))), F.lit(0)).cast("long").alias("total_token_count"),
    )
    links = distinct_links(F.flatten(F.transform("_links", lambda x: x["l"])))
    return out.select(
        key, "is_job_listing", "score", "has_pagination", "parent_container_selector", "next_page_element", links.alias("individual_job_links"),
        F.col("_child.child_job_link_selector").alias("child_job_link_selector"), "total_token_count", (F.lit(careers_url) if isinstance(careers_url, str) else careers_url).alias("careers_url"),
    )


def within_budget(df: DataFrame, tokens: str, budget: int, key: str, order: str) -> DataFrame:
    """Rows up to and including the one that reaches the budget: tokens before a row must be below it."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("tokens_before", F.coalesce(F.sum(F.coalesce(tokens, F.lit(0))).over(before), F.lit(0)).cast("long")).where(F.col("tokens_before") < budget)


def session_messages(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, messages): an ordered array of role and content per session."""
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("m"))
    return rows.select(key, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def first_k(df: DataFrame, k: int, key: str, order: list[str]) -> DataFrame:
    """The first k rows of each key (a window group limit prunes before the shuffle)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def detail_tokens(details: DataFrame, key: str, tokens: str = "total_token_count") -> DataFrame:
    """Token sums, nulls as 0; null instead of a sum of 0."""
    return details.groupBy(key).agg(F.nullif(F.sum(F.coalesce(tokens, F.lit(0))), F.lit(0)).alias("tokens"), F.count("*").alias("job_rows"))


def stage_rollup(events: DataFrame) -> DataFrame:
    """Count, total and longest duration per stage."""
    return events.groupBy("stage").agg(F.count("*").alias("events"), F.round(F.sum("duration_ms"), 2).alias("total_ms"), F.max("duration_ms").alias("longest_ms"))
