"""The operators as named queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patronlens.llm import decontamination, divergence, exact_dedup, jaccard_join, languages, licenses, line_dedup, lm, packing, quality, resampling, toxicity, url_filter
from patronlens.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


@query("op9_quality_rules", sql=quality.sql())
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.digest(docs)


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digest(table(spark, folder, "documents"))


@query("op7_language_mixture")
def op7_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (fold("doc_id", 3) == 1).alias("held_out"))
    model = languages.learn(docs.filter("NOT held_out"))
    return languages.identify(docs, ["doc_id", "held_out"], model)


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_backoff_automaton")
def op4_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out"))
    return lm.score(docs.withColumn("learns", ~docs.held_out), keep=("doc_id", "held_out"))


@query("op6_url_trees")
def op6_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.digest(table(spark, folder, "pages"))


def learned_toxicity(spark: SparkSession, folder: str):
    """Character model of all documents and the scorer learned from labels outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(fold("doc_id", 4) != 2)
    return toxicity.fitted(docs, labels)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model, scorer = learned_toxicity(spark, folder)
    docs = table(spark, folder, "documents").select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    return toxicity.score(docs, ["doc_id", "held_out"], model, scorer)


@query("op5_jaccard_join", sql=jaccard_join.sql())
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.digest(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_benchmark_leaks")
def op10_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op11_importance_resampling", sql=resampling.sql())
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_source_divergence", sql=divergence.sql())
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.digest(table(spark, folder, "documents"))


@query("op13_exact_dedup", sql=exact_dedup.sql())
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.digest(table(spark, folder, "documents"))
