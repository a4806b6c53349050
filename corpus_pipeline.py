"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All but the last
return the columns of ``docs``; columns beyond those of ``documents`` are carried along (one that has the
name of a stage's figure comes back with that figure). Rows that share an id are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.llm.base import materialise, settled, table, word_count
from edaphon.llm.line_dedup import remove_repeated_lines
from edaphon.llm.mixing import mixed_documents, short_first
from edaphon.llm.packing import pack_documents
from edaphon.llm.quality_rules import kept_documents
from edaphon.llm.queries import tokenizer_path
from edaphon.llm.simhash import near_duplicates


def with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``docs`` with another text and its length, and the given columns."""
    out = docs.withColumn("text", F.col(text))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go, then documents that the rules reject (NULL and short texts among them)."""
    return with_text(kept_documents(docs), "clean_text", docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an alike line earlier go, and with them documents in which nothing else stood."""
    out = remove_repeated_lines(docs)
    return with_text(out.filter((F.col("n_lines") == 0) | (F.col("n_lines") > F.col("n_equal") + F.col("n_near"))), "kept_text", docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that with the smallest id, without ids or between rows of one id
    that with the smallest hash of its text, then of the whole row."""
    rows = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    found = near_duplicates(rows, id="_row").select(F.col("doc_id").alias("_row"), "component_id")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    place = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", F.xxhash64("text").alias("text"), whole.alias("whole"), "_row")
    first = rows.select("_row", place.alias("_place")).join(found, "_row").groupBy("component_id").agg(F.min("_place").alias("_place"))
    return rows.join(first.select("_place._row"), "_row", "left_semi").select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(docs, word_count(F.col("text")), short_first(F.col("size")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place; a document taken twice is packed twice."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]
#: Hashing, sampling and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return materialise(STAGES[-1][1](spark, docs, sf_dir), "corpus")
