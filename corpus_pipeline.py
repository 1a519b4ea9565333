"""Corpus pipeline: each stage applies one operator to all that the stage before it kept.

quality rules (rejected documents go) -> line dedup (later repeats of three-line windows go, and documents that
lose all their words with them) -> n-gram join (one row of each near-duplicate group stays, of the least id) ->
secret scans (secrets are masked) -> packing (token pieces in sequences). Clean documents pass every filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.llm import line_dedup, ngram_join, packing, quality_rules, secret_scan
from siteweave.llm.common import discard, materialize, small_side, table
from siteweave.llm.tokens import word_tokenizer_path
from siteweave.session import ship

#: SQL can express neither the components of the n-gram join nor tokens.
ORACLE_SQL = None


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def _row(docs: DataFrame, *but: str) -> Column:
    """The row's columns as one, out of reach of any name that an operator uses."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in but))


def _columns(names: list[str], row: str) -> list[Column]:
    return [F.col(row).getField(c).alias(c) for c in names]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base checks and their language's and source's fences.

    A null or empty text has too few words and goes; repeated rows are judged alike and all stay or go; whole texts are
    read; no column of the documents is changed, whatever its name; of an empty table nothing is kept.
    """
    judged = quality_rules.adaptive_filter(docs.select(_row(docs).alias("row"), "lang", "source", "text"), carry=("row",))
    return judged.where("kept").select(*_columns(docs.columns, "row"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated windows of lines; a document left without a word by that goes.

    Texts that are null, empty or shorter than three lines stay as they are, as do all other columns but ``n_chars``,
    which follows the text; of repeated windows the one of the least id and line stays (null ids come first); rows of one
    id and text are one document, all with the same text; an empty table stays empty.
    """
    cut = line_dedup.remove_repeats(docs.select("doc_id", "text", _row(docs, "doc_id", "text").alias("row")))
    cut = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(line_dedup.WORD))
    return _with_length(cut.select(*(F.col(c) if c in ("doc_id", "text") else F.col("row").getField(c).alias(c) for c in docs.columns)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by five-word similarity of 0.8 or more, links of links too, keeps exactly one row.

    That is the one of the least id; an id comes before a null, and among texts of one id a hash of the text decides, among
    repeated rows the least of the other columns. Rows of one id are told apart by their texts, so a text that resembles no
    other stays whatever its id. Texts that are null, empty or without a word resemble nothing and all stay, repeated ones
    too. Columns are not changed, whatever their names; an empty table stays empty.
    """
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    groups = ngram_join.similarity_components(docs.select(own.alias("key"), "text"), ngram_join.JoinParams(words=5, percent=80), key="key")
    marks = groups.where("n_shingles > 0").groupBy("key").agg(F.max(F.col("key") != F.col("component_id")).alias("gone"), F.count("*").alias("n")).where("gone or n > 1")
    marks = materialize(marks.select("key", "gone"), "near-duplicates")
    marked = docs.select(_row(docs).alias("row"), own.alias("own")).join(small_side(marks), F.col("own") == F.col("key"), "left")
    single = marked.where("gone is null").select("row")
    again = marked.where("not gone").groupBy("own").agg(F.min("row").alias("row")).select("row")
    return single.unionByName(again).select(*_columns(docs.columns, "row"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in every whole text; all rows stay, with all columns but ``text`` and ``n_chars`` as they were.

    A null or empty text stays; repeated rows get the same text; an empty table stays empty.
    """
    return _with_length(secret_scan.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of every document into sequences; rows are pieces: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    A null or empty text is its end token alone; repeated rows are packed each; which pieces share a sequence depends on how
    the rows lie in partitions, and among equal pieces the earlier goes first; an empty table has no pieces.
    """
    return packing.pack_documents(docs, word_tokenizer_path(), end_id=1)


def _shipped(stage):
    """The stage, with this code sent to the executors before it runs."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    return run_stage


STAGES = [
    (name, _shipped(stage))
    for name, stage in (
        ("quality_rules", quality_stage),
        ("line_dedup", line_stage),
        ("ngram_join", near_duplicate_stage),
        ("secret_scans", secret_stage),
        ("packing", packing_stage),
    )
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Between stages the documents are a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        if hasattr(before, "written_at"):
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
