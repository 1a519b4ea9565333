"""Quality rules with adaptive thresholds: fixed base checks, then fences from mergeable KLL sketches per language and source.

Everything is DataFrame functions. Per document, counts of things (marks, capitals, ...) in a number of places (words,
characters). Per (lang, source), a quantile sketch of each rule's shares; sketches merge upwards to (lang) and to all
documents for groups too small to judge. The sketches alone set a group's fences: the upper quartile plus, and where
few is odd too the lower quartile less, ``fence`` interquartile ranges. No rule has a cutoff of its own.

A count in a short document says little, so it enters with its statistical error: the share sketched for the upper fence is
(count + 1) / (places + 1), which spreads with the group's lengths even where most documents count nothing (for the lower
one it is the plain share), and a document is beyond a fence only if its count less two standard errors (plus two and one,
below) still is. What comes in lumps, such as the five words of a repeated window, has the error of its lumps.

Counts and sketches cover every row; a row is scored once, into a written table, and joined with its group's fences.

Defined results: a null text has no words and fails the base checks (fewer than ten words); null languages or
sources are groups of their own; repeated rows are judged each; an empty table gives an empty result; extra
columns pass through ``score`` and ``keep`` untouched unless they have the name of a computed one, which then
replaces them; texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialize, small_side

WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Tasks that share the merging of a group's partial sketches.
MERGERS = 512


@dataclass(frozen=True)
class Rule:
    """``count`` in ``places``; ``lump`` is how many come at once; ``both``: too few is odd as well."""

    count: str
    places: str
    lump: int = 1
    both: bool = False


RULES = {
    "word_length": Rule("word_chars", "n_words", both=True),
    "symbols": Rule("n_symbols", "n_words"),
    "dup_lines": Rule("n_dup_lines", "n_words"),
    "repeats": Rule("n_repeat_words", "n_words", lump=5),
    "capitals": Rule("n_capitals", "word_chars"),
    "marks": Rule("n_marks", "n_words", both=True),
}


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_percent: int = 20
    sketch_k: int = 1024
    fence: float = 4.0
    min_group: int = 50


def _repeat_words(words: Column, n: Column) -> Column:
    """Words covered by five-word windows that occur twice or more. Log-linear in the text's length."""

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, i: F.when(i + 1 < F.size(at), F.least(F.lit(5), F.get(at, i + 1) - p)).otherwise(5))
        return F.aggregate(step, F.lit(0).cast("long"), lambda s, x: s + x)

    def positions(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))

    def repeats(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(let(ordered, positions), covered))

    windows = let(words, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 4), lambda i: F.xxhash64(F.slice(w, i, 5))))
    return F.when(n < 6, F.lit(0).cast("long")).otherwise(let(windows, repeats))


def score(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Adds the counts and ``base_failed`` to each row; needs a ``text`` column."""
    df = df.withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    df = df.withColumns({"_words": F.array_remove(F.split("_t", GAP), ""), "_lines": F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD))})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count("_t", F.lit(SYMBOL)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_words"), F.size("_words")),
            "n_capitals": F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long"),
            "n_marks": F.regexp_count("_t", F.lit("[.,;:!?]")).cast("long"),
        }
    )
    failed = (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_t", "_words", "_lines")


def sketches(scored: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """One row per (lang, source) with a count and a KLL sketch of each rule's shares.

    Every task has a partial sketch of every group. They are merged in two steps, those of a group in MERGERS parts first, so
    that a million tasks give no merging task more than some thousand sketches of a group.
    """
    shares = {}
    for name, rule in RULES.items():
        shares[f"{name}_hi"] = (F.col(rule.count) + 1) / (F.col(rule.places) + 1)
        if rule.both:
            shares[f"{name}_lo"] = F.col(rule.count) / F.col(rule.places)
    sketch = [F.kll_sketch_agg_double(share, F.lit(params.sketch_k)).alias(fence) for fence, share in shares.items()]
    part = F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("part")
    shared = scored.where(~F.col("base_failed")).groupBy("lang", "source", part).agg(F.count("*").alias("n"), *sketch)
    return shared.groupBy("lang", "source").agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(fence).alias(fence) for fence in shares))


def _fences(grouped: DataFrame, params: QualityParams) -> DataFrame:
    """Replaces each sketch by its fence: <rule>_hi, and for rules of both sides <rule>_lo."""
    cols = {}
    for fence in _fence_names(grouped):
        q1, q3 = (F.kll_sketch_get_quantile_double(fence, F.lit(q)) for q in (0.25, 0.75))
        cols[fence] = q3 + params.fence * (q3 - q1) if fence.endswith("_hi") else q1 - params.fence * (q3 - q1)
    return grouped.withColumns(cols)


def _fence_names(grouped: DataFrame) -> list[str]:
    return [c for c in grouped.columns if c not in ("lang", "source", "n")]


def thresholds(grouped: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(t_lang, t_source, t_<fence>...) per group; groups under ``min_group`` rows take their language's fences, else those of all rows."""
    names = _fence_names(grouped)
    merge = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(c).alias(c) for c in names)]
    own = _fences(grouped, params)
    lang = _fences(grouped.groupBy("lang").agg(*merge), params).select(F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), *(F.col(c).alias(f"l_{c}") for c in names))
    every = _fences(grouped.agg(*merge), params).select(*(F.col(c).alias(f"a_{c}") for c in names))
    out = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(every))  # one row
    pick = lambda c: F.when(F.col("n") >= params.min_group, F.col(c)).when(F.col("l_n") >= params.min_group, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}"))
    return out.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *(pick(c).alias(f"t_{c}") for c in names))


def _outside(name: str, rule: Rule) -> Column:
    """Whether the count, less or plus two standard errors, is still beyond the group's fence."""
    count, places = F.col(rule.count), F.col(rule.places)
    error = 2 * F.sqrt(rule.lump * count)
    out = (count - error) / places > F.col(f"t_{name}_hi")
    if rule.both:
        out = out | ((count + error + 1) / places < F.col(f"t_{name}_lo"))
    return F.coalesce(out, F.lit(False))


def keep(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``kept``: false if the base checks fail or a count is beyond its group's fence."""
    on = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    outside = F.lit(False)
    for name, rule in RULES.items():
        outside = outside | _outside(name, rule)
    return scored.join(limits, on, "left").withColumn("kept", ~F.col("base_failed") & ~outside).drop(*limits.columns)


def adaptive_filter(df: DataFrame, params: QualityParams = QualityParams(), carry: tuple[str, ...] = ()) -> DataFrame:
    """Judged rows: the ``carry`` columns, lang, source, the counts, ``base_failed`` and ``kept``. A carried column of a computed
    one's name gives way to it; carry a struct to have any."""
    scored = score(df.select(*dict.fromkeys((*carry, "lang", "source", "text"))), params)
    scored = materialize(scored if "text" in carry else scored.drop("text"), "quality")
    limits = small_side(materialize(thresholds(sketches(scored, params), params), "fences"))
    return keep(scored, limits)
