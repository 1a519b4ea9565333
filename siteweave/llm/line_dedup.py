"""Line dedup by overlapping windows of three consecutive lines.

Every window of three lines (``\\n``-split, at least one word in them) is hashed; windows that repeat anywhere in
the corpus are found by one aggregation; of a repeated window the first occurrence, by key and line, stays, and the
later ones cover their lines. Covered positions of a document are merged and those lines are removed.

Only hashes and positions are shuffled for the search; window counts combine before the shuffle and hot windows
are split by adaptive skew joins. DataFrame functions throughout.

Defined results: a null text stays null; an empty text and one of fewer than three lines stay as they are; rows with the
same key and text count as one document and get the same text; texts of any length are read whole; an empty
table gives an empty result; extra columns pass through (computed columns replace those of their name). Null
keys come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

WINDOW = 3
WORD = r"[^\x20\x09-\x0D]"


def windows(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, mark, pos, a, b): each window's place and 128-bit hash; ``mark`` tells texts of one key apart."""

    def hashed(lines: Column) -> Column:
        def one(i: Column) -> Column:
            three = F.slice(lines, i + 1, WINDOW)
            return F.struct(i.cast("int").alias("pos"), F.xxhash64(three).alias("a"), F.xxhash64(F.lit(1), three).alias("b"), F.exists(three, lambda x: x.rlike(WORD)).alias("word"))

        return F.when(F.size(lines) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(lines) - WINDOW), one)).otherwise(F.array())

    df = df.where(F.col("text").isNotNull()).select(F.col(key).alias("_key"), F.xxhash64("text").alias("_mark"), F.explode(let(F.split("text", "\n"), hashed)).alias("w"))
    return df.where("w.word").select("_key", "_mark", "w.pos", "w.a", "w.b")


def covered_lines(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, mark, spots): starts of the windows to remove, per document."""
    found = windows(df, key)
    place = F.struct("_key", "_mark", "pos")
    repeated = found.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(repeated, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("_key", "_mark").agg(F.collect_set("pos").alias("_spots"))


def _kept(lines: Column, spots: Column) -> Column:
    covered = F.flatten(F.transform(spots, lambda p: F.sequence(p, p + WINDOW - 1)))
    return let(lines, lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), covered), lambda i: F.get(x, i)))


def remove_repeats(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows with repeated windows removed from ``text``, and n_lines and n_removed added."""
    spots = covered_lines(df, key)
    others = [c for c in df.columns if c not in ("text", "n_lines", "n_removed")]
    own = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), F.col(key).alias("_id"), F.col("text").alias("_text"), F.xxhash64("text").alias("_own_mark"))
    out = own.join(spots, F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_own_mark") == F.col("_mark")), "left")
    lines = F.split("_text", "\n")
    out = out.withColumn("_kept", F.when(F.col("_spots").isNotNull(), _kept(lines, F.col("_spots"))))
    text = F.when(F.col("_spots").isNotNull(), F.array_join("_kept", "\n")).otherwise(F.col("_text")).alias("text")
    n_lines = F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines")
    n_removed = F.when(F.col("_spots").isNotNull(), F.size(lines) - F.size("_kept")).otherwise(F.lit(0)).cast("long").alias("n_removed")
    kept = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    return out.select(*(text if c == "text" else F.col("_row").getField(c).alias(c) for c in kept), n_lines, n_removed)
