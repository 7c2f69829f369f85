"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of documents. What a stage drops is written as a small table of keys
first, so that Spark sees its true size when it joins the documents against it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship, staged, table
from ledgerloom.llm.decontamination import contamination
from ledgerloom.llm.language import identify
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.ngram_jaccard import link_components
from ledgerloom.llm.token_files import encode_and_read


#: Shingles of the near_duplicates stage; op9's own are narrower and must be more alike.
WIDTH, PERCENT = 5, 80
#: The columns of documents that stages look at.
TAKEN = ("doc_id", "text", "lang", "source")


def _without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """The documents whose id is not among the dropped ones."""
    return docs.join(staged(dropped.where("doc_id IS NOT NULL").distinct(), name), "doc_id", "left_anti").select(docs.columns)


def _mark(docs: DataFrame) -> Column:
    """What tells a row from all that differ from it, rows of one id or none included."""
    return F.xxhash64(*(x for c in TAKEN if c in docs.columns for x in (F.col(c), F.col(c).isNull())))


def _unmarked(docs: DataFrame, marks: DataFrame, name: str) -> DataFrame:
    """The documents whose mark is not among the given ones; columns of any name stay as they are."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), _mark(docs).alias("mark"))
    return held.join(staged(marks.distinct(), name), "mark", "left_anti").select("doc.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that show one of the known languages; text without letters or of no known language goes.

    Null and empty texts have no letters and go. Every row is judged by itself, so rows of one id, or without
    an id, may fare differently; equal rows fare alike. An empty table stays empty; other columns are kept.
    """
    ship(spark)
    judged = identify(docs.select("doc_id", "text", "lang", "source", _mark(docs).alias("_mark")), keys=["_mark"])
    return _unmarked(docs, judged.where("NOT accepted").select(F.col("_mark").alias("mark")), "rejected")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a five-word shingle similarity of 0.8 or more, the one with the smallest id stays.

    Null and empty texts, and rows without an id, are connected with nothing and stay. Rows of one id are one document, of
    which one row stays. An empty table stays empty; very long texts are compared whole; other columns are kept.
    """
    ship(spark)
    linked = staged(link_components(docs, width=WIDTH, percent=PERCENT), "linked")
    kept = _without(docs, linked.where("component_id <> id").select(F.col("id").alias("doc_id")), "copies")
    repeated = linked.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select(F.col("id").alias("doc_id"))
    if repeated.limit(1).count():  # rows of one id are one document
        repeated = staged(repeated, "repeated")
        once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
        kept = _without(kept, repeated, "repeated").unionByName(once)
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    Every row is judged by its own text, rows of one id or without an id too. Null and empty texts have no windows and
    stay, as does everything if the benchmark is empty. An empty table stays empty; other columns are kept.
    """
    ship(spark)
    found = contamination(docs.select(_mark(docs).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _unmarked(docs, found.where("contaminated").select(F.col("doc_id").alias("mark")), "contaminated")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources flattened by temperature to a repetition of at most 1.25; every document stays, some come twice.

    A null source is a source of its own. Rows of one id stay together, so do rows without one. Texts without words weigh
    nothing and come once. An empty table stays empty; other columns are kept.
    """
    ship(spark)
    mixed, _ = mix(docs, number="__pass")
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files in ascending document id, and what they hold per document.

    A null text holds only the end id. Rows of one id stand together, rows without an id come first. An empty table gives
    no files and no rows; other columns are not stored.
    """
    ship(spark)
    return encode_and_read(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Hash permutations, trained models and the id coder have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
