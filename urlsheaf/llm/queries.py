"""One query for each operator, over its whole table, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsheaf.llm import (
    chat,
    decontaminate,
    embeddings,
    licences,
    lines,
    packing,
    passages,
    quality,
    runs,
    search,
    simhash,
    toxicity,
    urls,
)
from urlsheaf.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def vocabulary() -> str:
    """Where the public tokenizer's vocabulary lies on driver and executors."""
    return public_tokenizers.path("word_bpe_49k.json")


@_query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@_query("op2_url_filters", urls.URLS_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


@_query("op3_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents"))


@_query("op4_line_dedup", lines.LINES_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


@_query("op5_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


@_query("op6_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@_query("op7_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@_query("op8_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@_query("op9_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op10_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@_query("op11_chat_formatting", chat.CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spiked = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.SPIKED).alias("text"),
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(spiked)))


@_query("op12_ranked_search", search.SEARCH_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(runs.looped(table(spark, sf_dir, "documents"))).drop("runs")
