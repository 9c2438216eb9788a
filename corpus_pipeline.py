"""From raw documents to packed sequences: every stage is one operator of ``urlsheaf.llm`` over all rows that the one
before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.llm import decontaminate, lines, nearcopies, packing, quality, queries
from urlsheaf.llm.common import Scratch, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), 0.3)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later one keeps; all documents stay, ``n_chars`` is counted anew."""
    kept = lines.dedupe_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies: five-word similarity of 0.8 or more."""
    return nearcopies.keep_one_similar(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs, queries.vocabulary())


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_common_lines),
    ("simhash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmarks),
    ("best-fit packing", packed),
]
#: Neither trained weights nor token ids can be had in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        made = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{k}")
        if k:
            scratch.drop(f"pipeline-{k - 1}")
        docs = made
    return docs
